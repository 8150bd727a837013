"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are the byte n-grams of its lower-cased words, a blank standing for a
word's edge; each is hashed to a row of an embedding table and the rows are averaged. Table
and softmax are trained by stochastic gradient descent in numpy on a bounded sample. Part of
the sample calibrates the scores (a temperature) and the confidence under which a text is
rejected. As averaging is linear, table and softmax are multiplied once, and scoring is a
sum of one row per subword.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placeledger.llm.common import drawn, fold, records, text_slices

GRAMS = (2, 3, 4)
BITS = 12
DIMENSIONS = 16
ROWS_PER_LANGUAGE = 800
LEARN_FOLDS = 5
REJECTED_SHARE = 0.001
UNDETERMINED = "und"
MIX = np.uint64(0x9E3779B97F4A7C15)
LETTER = re.compile(r"[^\W\d_]")
# Bytes of words: ASCII letters and everything beyond ASCII; all others are blanks.
WORD_BYTES = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_only(text: str | None) -> bytes:
    """Lower-cased text as bytes between blanks, all other characters blank."""
    return b" " + (text or "").lower().encode("utf-8", "ignore").translate(WORD_BYTES) + b" "


def subwords(text: np.ndarray, bits: int = BITS) -> Iterator[np.ndarray]:
    """For each n-gram length the table row at every byte; 1 << bits where there is none.

    An n-gram may start or end with a blank but holds none inside, so none crosses words.
    """
    wide = text.astype(np.uint64)
    blank = text == 32
    for n in GRAMS:
        count = max(len(text) - n + 1, 0)
        packed = np.full(count, n, dtype=np.uint64)
        for k in range(n):
            packed = packed << np.uint64(8) | wide[k:k + count]
        rows = (packed * MIX >> np.uint64(64 - bits)).astype(np.int64)
        inside = np.zeros(count, dtype=bool)
        for k in range(1, n - 1):
            inside |= blank[k:k + count]
        rows[inside | (blank[:count] & blank[n - 1:n - 1 + count])] = 1 << bits
        yield rows


def counts(text: str | None, bits: int = BITS) -> np.ndarray:
    """Occurrences of each table row in the text."""
    total = np.zeros((1 << bits) + 1)
    for rows in subwords(np.frombuffer(words_only(text), dtype=np.uint8), bits):
        total += np.bincount(rows, minlength=len(total))
    return total[:-1]


@dataclass
class LanguageModel:
    languages: list[str]
    rows: np.ndarray  # (1 << bits) + 1 by languages; the last row is zero
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Calibrated probabilities, text by language."""
        parts = [words_only(t) for t in texts]
        sums, found = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        if texts:
            text = np.frombuffer(b"".join(parts), dtype=np.uint8)
            starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
            for rows in subwords(text):
                rows = np.concatenate([rows, np.full(len(text) - len(rows), len(self.rows) - 1)])
                sums += np.add.reduceat(self.rows[rows], starts, axis=0, dtype=np.float64)
                found += np.add.reduceat(rows != len(self.rows) - 1, starts, dtype=np.int64)
        return softmax((sums / np.maximum(found, 1)[:, None] + self.bias) / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


@dataclass
class Shares:
    """Rows of shares of table rows, kept by what is not zero."""

    at: list[np.ndarray]  # the row's table rows, ascending
    share: list[np.ndarray]
    width: int

    def __len__(self) -> int:
        return len(self.at)

    def dense(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), self.width), dtype=np.float32)
        for k, row in enumerate(rows):
            out[k, self.at[row]] = self.share[row]
        return out


def shares(features: np.ndarray) -> Shares:
    """`features` (counts) as shares of each row's sum."""
    at = [np.flatnonzero(row) for row in features]
    return Shares(at, [(row[a] / max(row.sum(), 1)).astype(np.float32) for a, row in zip(at, features)], features.shape[1])


def train(
    features: np.ndarray | Shares, labels: np.ndarray, languages: list[str], epochs: int = 20, rate: float = 3.0,
    batch: int = 32, seed: int = 5, rejected_share: float = REJECTED_SHARE,
) -> LanguageModel:
    """Fit on four fifths of the rows of `features` (counts, or shares made of them); calibrate
    on the others. Only a few rows at a time are written out with their zeros."""
    rng = np.random.default_rng(seed)
    means = features if isinstance(features, Shares) else shares(features)
    order = rng.permutation(len(means))
    apart = max(1, len(order) // 5) if len(order) > 1 else 0
    held, used = order[:apart], order[apart:]
    # Rare languages weigh as much as common ones.
    weight = (1 / np.bincount(labels[used], minlength=len(languages)).clip(1))[labels]
    weight = (weight / weight[used].mean()).astype(np.float32)
    table = rng.normal(0, 1 / DIMENSIONS, (means.width, DIMENSIONS)).astype(np.float32)
    top = np.zeros((DIMENSIONS, len(languages)), dtype=np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    target = np.eye(len(languages), dtype=np.float32)[labels]
    steps, step = epochs * -(-len(used) // batch), 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(used), max(1, -(-len(used) // batch))):
            now = rate * (1 - step / steps)
            step += 1
            x = means.dense(at)
            hidden = x @ table
            error = (softmax(hidden @ top + bias) - target[at]) * weight[at][:, None] / len(at)
            back = error @ top.T
            top -= now * hidden.T @ error
            bias -= np.float32(0.1) * now * error.sum(axis=0)
            # A subword's share of a text is small; its row gets the longer step.
            table -= now * 20 * x.T @ back
    held = held if len(held) else used
    parts = np.array_split(held, max(1, -(-len(held) // batch)))
    logits = np.concatenate([means.dense(part) @ table for part in parts]) @ top + bias
    own = np.arange(len(held)), labels[held]
    heat = min(np.geomspace(0.05, 20, 60), key=lambda t: -np.log(softmax(logits / t)[own] + 1e-12).mean())
    sure = softmax(logits / heat).max(axis=1)
    threshold = min(0.5, float(np.quantile(sure, rejected_share)))
    rows = np.concatenate([table @ top, np.zeros((1, len(languages)), dtype=np.float32)])
    return LanguageModel(languages, rows.astype(np.float32), bias, float(heat), threshold)


def fit_languages(
    docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageModel | None:
    """Learn from at most `rows_per_language` texts of each language, drawn by a hash of
    doc_id among the documents of the learning folds; None if there are none."""
    known = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), LEARN_FOLDS) != 0))
    ids = drawn(known.select("doc_id", "lang").distinct(), "lang", "doc_id", rows_per_language)
    # At most rows_per_language ids a language.
    chosen = known.join(F.broadcast(ids), ["doc_id", "lang"]).dropDuplicates(["doc_id", "lang"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [counts(t.as_py()) for t in batch.column("text")]
            at = [np.flatnonzero(c) for c in every]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.string()), batch.column("lang"),
                pa.array([a.astype("<u2").tobytes() for a in at], type=pa.binary()),
                pa.array([c[a].astype("<f4").tobytes() for a, c in zip(at, every)], type=pa.binary()),
            ], ["doc_id", "lang", "at", "n"])

    rows = chosen.mapInArrow(run, "doc_id string, lang string, at binary, n binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["doc_id"] or ""))
    languages = sorted({r["lang"] for r in rows})
    labels = np.array([languages.index(r["lang"]) for r in rows])
    # The counts are whole numbers: their sum is exact in any order.
    at = [np.frombuffer(r["at"], dtype="<u2") for r in rows]
    share = [n / max(n.sum(), 1) for n in (np.frombuffer(r["n"], dtype="<f4") for r in rows)]
    del rows
    return train(Shares(at, share, 1 << BITS), labels, languages)


def judged(model: LanguageModel | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and rejection of each text."""
    lettered = np.array([bool(t and LETTER.search(t)) for t in texts], dtype=bool)
    if model is None:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
    chances = model.scores(texts)
    best = np.where(lettered, chances.max(axis=1), 0.0)
    named = [model.languages[k] if ok else UNDETERMINED for k, ok in zip(chances.argmax(axis=1), lettered)]
    return named, best, ~lettered | (best < model.threshold)


def judged_batch(model: LanguageModel | None, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    parts = [judged(model, texts) for texts in text_slices(column)] or [judged(model, [])]
    return [n for p in parts for n in p[0]], np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])


def predict_languages(
    docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, lang_pred, score (0 to 1), rejected.

    A text that is null or has no letter is `und`, score 0, rejected; so is every text when
    there is no model. Other texts get the likeliest learned language, and are rejected
    when the calibrated score is under the model's threshold. Repeated rows stay.
    """
    source = records(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, best, rejected = judged_batch(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(named, type=pa.string()), pa.array(best), pa.array(rejected)],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return source.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def identify_languages(docs: DataFrame, **options) -> DataFrame:
    """Learn from `docs` and predict for all of them; held_out tells which could not be learned from."""
    return predict_languages(docs, fit_languages(docs, **options)).select(
        "doc_id", (fold(F.col("doc_id"), LEARN_FOLDS) == 0).alias("held_out"), "lang_pred", "score", "rejected",
    )


def keep_identified(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose text is not rejected; nothing is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~judged_batch(model, batch.column(text_col))[2]))

    return docs.mapInArrow(run, docs.schema)
