"""Toxicity by a counterfactually regularised classifier.

A text's features are the hashed words it has and their first letters, present or not, so a
few words tell in a text of any length. A logistic model over the features that the labels
make most telling is fitted in numpy on a bounded sample. In every labelled text that
mentions a group, the mentions are swapped for the same form of each other group's name, and the squared change of the text's score is part of the loss: naming a group must
not move a score by itself. A corpus that names no group is fitted without that part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placeledger.llm.common import drawn, fold, records, text_slices, written
from placeledger.llm.langid import MIX, words_only

BITS = 20
PREFIXES = (4, 5, 6)
ROWS_PER_CLASS = 4000
FEATURES = 2000
LEARN_FOLDS = 5
SWAP_PENALTY = 4.0
# Names of groups that a neutral text may mention; a parameter of `fit_toxicity`. Names with the
# same forms are swapped for each other: here singular and plural in English, then in French,
# German and Spanish. One word may stand for several forms.
IDENTITY_TERMS: tuple[tuple[tuple[str, ...], ...], ...] = ((
    ("muslim", "muslims", "musulman", "musulmans", "moslem", "muslime", "musulmán", "musulmanes"),
    ("christian", "christians", "chrétien", "chrétiens", "christ", "christen", "cristiano", "cristianos"),
    ("jew", "jews", "juif", "juifs", "jude", "juden", "judío", "judíos"),
    ("hindu", "hindus", "hindou", "hindous", "hindu", "hindus", "hindú", "hindúes"),
    ("buddhist", "buddhists", "bouddhiste", "bouddhistes", "buddhist", "buddhisten", "budista", "budistas"),
    ("atheist", "atheists", "athée", "athées", "atheist", "atheisten", "ateo", "ateos"),
    ("woman", "women", "femme", "femmes", "frau", "frauen", "mujer", "mujeres"),
    ("man", "men", "homme", "hommes", "mann", "männer", "hombre", "hombres"),
    ("gay", "gays", "gay", "gays", "schwuler", "schwule", "gay", "gays"),
    ("lesbian", "lesbians", "lesbienne", "lesbiennes", "lesbe", "lesben", "lesbiana", "lesbianas"),
    ("straight", "straights", "hétéro", "hétéros", "hetero", "heteros", "hetero", "heteros"),
    ("transgender", "transgenders", "transgenre", "transgenres", "transperson", "transpersonen", "transgénero", "transgéneros"),
    ("black", "blacks", "noir", "noirs", "schwarzer", "schwarze", "negro", "negros"),
    ("white", "whites", "blanc", "blancs", "weißer", "weiße", "blanco", "blancos"),
    ("asian", "asians", "asiatique", "asiatiques", "asiate", "asiaten", "asiático", "asiáticos"),
    ("latino", "latinos", "latino", "latinos", "latino", "latinos", "latino", "latinos"),
    ("arab", "arabs", "arabe", "arabes", "araber", "araber", "árabe", "árabes"),
    ("immigrant", "immigrants", "immigré", "immigrés", "einwanderer", "einwanderer", "inmigrante", "inmigrantes"),
    ("refugee", "refugees", "réfugié", "réfugiés", "flüchtling", "flüchtlinge", "refugiado", "refugiados"),
    ("native", "natives", "autochtone", "autochtones", "einheimischer", "einheimische", "nativo", "nativos"),
),)
# The same, for adjectives in the four languages.
IDENTITY_ADJECTIVES: tuple[tuple[tuple[str, ...], ...], ...] = ((
    ("islamic", "islamique", "muslimisch", "islámico"), ("christianity", "chrétienne", "christlich", "cristiana"),
    ("jewish", "juive", "jüdisch", "judía"), ("hinduism", "hindoue", "hinduistisch", "hinduista"),
    ("female", "féminin", "weiblich", "femenino"), ("male", "masculin", "männlich", "masculino"),
    ("disabled", "handicapé", "behindert", "discapacitado"), ("elderly", "âgé", "betagt", "anciano"),
    ("young", "jeune", "jung", "joven"),
),)
BASE = np.uint64(0x100000001B3)
INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_features(text: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word's first byte, feature) for every word and each of its prefixes.

    Hashes of all words come from one running polynomial over the bytes.
    """
    inside = text != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    running = np.concatenate([[np.uint64(0)], np.add.accumulate(text.astype(np.uint64) * powers(BASE, len(text))[:-1])])
    back = powers(INVERSE, len(text))
    at, features = [], []
    for k in (0, *PREFIXES):
        own = slice(None) if k == 0 else ends - starts > k
        first = starts[own]
        last = ends if k == 0 else first + k
        value = (running[last] - running[first]) * back[first] + np.uint64(k)
        value = (value ^ value >> np.uint64(29)) * MIX
        at.append(first)
        features.append((value >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(at), np.concatenate(features)


def features_of(text: str | None) -> np.ndarray:
    """Distinct features of one text, ascending."""
    return np.unique(word_features(np.frombuffer(words_only(text), dtype=np.uint8))[1])


@cache
def forms(terms: tuple) -> dict[bytes, list[bytes]]:
    """Each form's swaps: the same form of the other groups. A word that stands for
    several forms takes the first."""
    out: dict[bytes, list[bytes]] = {}
    for kind in terms:
        for group in kind:
            for place, form in enumerate(group):
                word = words_only(form).strip()
                others = [words_only(other[place]).strip() for other in kind if other is not group]
                out.setdefault(word, [o for o in others if o != word])
    return out


def swapped(text: str | None, terms: tuple = IDENTITY_TERMS + IDENTITY_ADJECTIVES) -> list[np.ndarray]:
    """Features of the text with its mentions of groups swapped: one text for each other group.
    None where no group is mentioned."""
    words, known = words_only(text).split(), forms(terms)
    places = [k for k, w in enumerate(words) if known.get(w)]
    out = []
    for turn in range(max((len(known[words[k]]) for k in places), default=0)):
        other = [*words]
        for k in places:
            other[k] = known[words[k]][turn % len(known[words[k]])]
        out.append(np.unique(word_features(np.frombuffer(b" " + b" ".join(other) + b" ", dtype=np.uint8))[1]))
    return out


class Presence:
    """A 0/1 matrix kept as the columns of its ones, row after row."""

    def __init__(self, sets: list[np.ndarray], columns: np.ndarray):
        found = [np.searchsorted(columns, s[np.isin(s, columns)]).astype(np.int32) for s in sets]
        self.rows, self.width = len(sets), len(columns)
        self.row = np.repeat(np.arange(len(sets), dtype=np.int32), [len(f) for f in found])
        self.column = np.concatenate([np.zeros(0, dtype=np.int32), *found])

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.rows)

    def turned_times(self, e: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, e[self.row], self.width)


@dataclass
class ToxicityModel:
    features: np.ndarray  # ascending
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        parts = [words_only(t) for t in texts]
        slot = np.full(1 << BITS, -1, dtype=np.int32)
        slot[self.features] = np.arange(len(self.features))
        total = np.full(len(texts), self.bias)
        if texts and len(self.features):
            at, found = word_features(np.frombuffer(b"".join(parts), dtype=np.uint8))
            own = slot[found]
            at, own = at[own >= 0], own[own >= 0]
            doc = np.searchsorted(np.cumsum([len(p) for p in parts]), at, side="right")
            seen = np.unique(doc * len(self.features) + own)
            np.add.at(total, seen // len(self.features), self.weights[seen % len(self.features)])
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def telling(docs: list[np.ndarray], labels: np.ndarray, most: int) -> np.ndarray:
    """The features with the largest chi-square between presence and label, over a floor
    that chance seldom reaches."""
    n = np.array([(labels == 0).sum(), (labels == 1).sum()], dtype=float)
    seen = np.zeros((2, 1 << BITS))
    for d, label in zip(docs, labels):
        seen[label, d] += 1
    # A feature of a single text is chance.
    often = np.flatnonzero(seen.sum(axis=0) > 1)
    toxic, both = seen[1, often], seen[:, often].sum(axis=0)
    share = n[1] / max(n.sum(), 1)
    spread = np.maximum(both * share * (1 - share) * (1 - both / max(n.sum(), 1)), 1e-9)
    chi = (toxic - both * share) ** 2 / spread
    best = np.argsort(-chi, kind="stable")[:most]
    return np.sort(often[best[chi[best] > 6.6]])


def train(
    docs: list[np.ndarray], labels: np.ndarray, prior: float, swaps: list[list[np.ndarray]] = (),
    penalty: float = SWAP_PENALTY, most: int = FEATURES, ridge: float = 0.3, rounds: int = 400,
) -> ToxicityModel:
    """Accelerated gradient descent on logistic loss + ridge + penalty * mean squared swap change.

    `docs`: distinct features of each labelled text; `swaps`: those of its swapped texts;
    `prior`: share of toxic texts among all labelled ones, towards which the balanced fit is
    moved. A swap's change is over the text's own features: a name that the text has already
    is no change.
    """
    pairs = [(d, s) for d, texts in zip(docs, swaps) for s in texts]
    kept = np.unique(np.concatenate([telling(docs, labels, most), *(np.setxor1d(d, s) for d, s in pairs)]).astype(np.int64))

    def rows(sets: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(sets), len(kept)), dtype=np.float32)
        for i, d in enumerate(sets):
            x[i, np.searchsorted(kept, d[np.isin(d, kept)])] = 1
        return x

    x = Presence(docs, kept)
    # Texts often change alike; equal changes are one row with its share.
    turned = (rows([s for _, s in pairs]) - rows([d for d, _ in pairs])).astype(np.int8)
    change, often = np.unique(turned, axis=0, return_counts=True) if len(turned) else (turned, np.zeros(0))
    change = change.astype(np.float32)
    share = often.astype(np.float32) / max(often.sum(), 1)
    size = max(len(docs), 1)
    balance = np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
    y = labels.astype(np.float32)

    def slope(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        error = (1 / (1 + np.exp(-np.clip(x.times(w) + b, -60, 60))) - y) * balance / size
        pull = change.T @ (share * (change @ w)) if len(change) else 0
        return x.turned_times(error) + ridge / size * w + 2 * penalty * pull, float(error.sum())

    # The largest curvature, by a few power steps.
    v = np.full(len(kept) + 1, 1 / np.sqrt(len(kept) + 1), dtype=np.float32)
    steep = 1.0
    for _ in range(12):
        seen = (x.times(v[:-1]) + v[-1]) * balance
        g = np.append(x.turned_times(seen / size * 0.25), seen.mean() * 0.25)
        if len(change):
            g[:-1] += 2 * penalty * (change.T @ (share * (change @ v[:-1])))
        steep = float(np.linalg.norm(g))
        v = (g / max(steep, 1e-12)).astype(np.float32)
    step = 1 / (1.1 * steep + ridge / size + 1e-6)
    w, b = np.zeros(len(kept), dtype=np.float32), 0.0
    wp, bp = w, b
    for k in range(rounds):
        beta = k / (k + 3)
        at, bat = w + beta * (w - wp), b + beta * (b - bp)
        g, gb = slope(at, bat)
        wp, bp = w, b
        w, b = (at - step * g).astype(np.float32), bat - step * gb
    # Fitted on balanced labels; half of the labels' own odds keeps rare toxic texts in reach.
    odds = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)) if 0 < prior < 1 else 0.0
    return ToxicityModel(kept, w.astype(np.float64), float(b + odds * 0.5))


def telling_features(rows: DataFrame, most: int) -> list[int]:
    """The features of `at` with the largest chi-square between presence and label: what
    `telling` finds, over all rows at once, without the features of each."""
    n = rows.agg(F.count("*").alias("n"), F.avg("toxic").alias("share")).first()
    seen = rows.select("toxic", F.explode("at").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("bad"), F.count("*").alias("both")).filter("both > 1")
    total, share = float(n["n"]), n["share"] or 0.0
    spread = F.greatest(F.col("both") * F.lit(share * (1 - share)) * (1 - F.col("both") / F.lit(max(total, 1.0))), F.lit(1e-9))
    chi = F.pow(F.col("bad") - F.col("both") * F.lit(share), F.lit(2.0)) / spread
    best = seen.withColumn("chi", chi).orderBy(F.desc("chi"), "feature").limit(most)
    return [r["feature"] for r in best.collect()]


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS,
    terms: tuple = IDENTITY_TERMS + IDENTITY_ADJECTIVES, penalty: float = SWAP_PENALTY, most: int = FEATURES,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> ToxicityModel | None:
    """Learn from at most `rows_per_class` texts of each label, drawn by a hash of doc_id among
    the labelled documents of the learning folds; None if a label is missing. A document
    with both labels counts as toxic. Only the most telling features, and those a swap
    changes, come to the driver."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).filter(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), LEARN_FOLDS) != 0)
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = drawn(known, "toxic", "doc_id", rows_per_class)
    # At most 2 * rows_per_class ids.
    chosen = records(docs, id_col, text_col).join(F.broadcast(ids), "doc_id")
    kinds = [pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32()))]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in text_slices(batch.column("text")):
                own, others = [features_of(t) for t in texts], [swapped(t, terms) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(done, len(texts)).cast(pa.string()), batch.column("toxic").slice(done, len(texts)),
                    pa.array(own, type=kinds[0]), pa.array(others, type=kinds[1])], ["doc_id", "toxic", "at", "swaps"])
                done += len(texts)

    rows = written(chosen.dropDuplicates(["doc_id"]).mapInArrow(
        features, "doc_id string, toxic int, at array<int>, swaps array<array<int>>"), "toxic-features")
    # Rounding apart, the fit picks the same ones again among these.
    best = np.array(sorted(telling_features(rows, 2 * most)), dtype=np.int64)

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, others = [], []
            for at, swaps in zip(batch.column("at").to_pylist(), batch.column("swaps").to_pylist()):
                at, swaps = np.array(at, dtype=np.int64), [np.array(s, dtype=np.int64) for s in swaps]
                moved = np.unique(np.concatenate([at[:0], *(np.setxor1d(at, s) for s in swaps)]))
                wanted = np.union1d(best, moved)
                own.append(at[np.isin(at, wanted)])
                others.append([s[np.isin(s, wanted)] for s in swaps])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(own, type=kinds[0]), pa.array(others, type=kinds[1])],
                ["doc_id", "toxic", "at", "swaps"])

    rows = rows.mapInArrow(few, "doc_id string, toxic int, at array<int>, swaps array<array<int>>").collect()
    shares = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not rows or len({r["toxic"] for r in rows}) < 2:
        return None
    rows.sort(key=lambda r: r["doc_id"])
    return train(
        [np.array(r["at"], dtype=np.int64) for r in rows], np.array([r["toxic"] for r in rows]),
        shares[1] / (shares[0] + shares[1]), [[np.array(s, dtype=np.int64) for s in r["swaps"]] for r in rows], penalty, most)


def batch_scores(model: ToxicityModel | None, column: pa.Array) -> np.ndarray:
    if model is None:
        return np.zeros(len(column))
    return np.concatenate([np.zeros(0), *[model.scores(texts) for texts in text_slices(column)]])


def score_toxicity(
    docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, score (0 to 1), predicted (1 if score >= 0.5).

    Null, empty and wordless texts get the score of a text without any telling word; very long
    texts are scored whole. Without a model every score is 0. Repeated rows stay, ties have one
    score; an empty table gives no rows.
    """
    source = records(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = batch_scores(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    scored = source.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify_toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Learn from the labels and score all documents; held_out tells which could not be learned from."""
    return score_toxicity(docs, fit_toxicity(docs, labels, **options)).select(
        "doc_id", (fold(F.col("doc_id"), LEARN_FOLDS) == 0).alias("held_out"), "score", "predicted",
    )


def keep_civil(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that are not predicted toxic; nothing is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(batch_scores(model, batch.column(text_col)) < 0.5))

    return docs.mapInArrow(run, docs.schema)
