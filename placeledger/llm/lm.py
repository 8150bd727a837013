"""Language-model scoring by deleted interpolation.

An n-gram's probability mixes the maximum-likelihood estimates of its orders and the uniform
one. The weights depend on how often the longest context was seen (buckets of powers of
two) and are learned by expectation-maximisation: a tenth of the training documents, drawn by
a hash of each, is deleted from the counts and its tokens are predicted from the rest.

Counts are never gathered in one place. Documents are dealt to batches; a batch names each of
its n-grams once, with its own count, to the bucket that holds the n-gram; the bucket adds up
what all batches say and answers each with the total. So a frequent n-gram costs one entry a
batch, and one exchange serves counting and looking up. n-grams travel as 64-bit hashes of
their words.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from placeledger.llm.common import fold, records, slices, tasks, written

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LEARN_FOLDS = 10
BATCH_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
DELETED = 10
CONTEXT_BUCKETS = 24
BASE_ADD = 0.1
START = np.uint64(0x5851F42D4C957F2D)
END = b"\n"  # no word can be this
MIX = np.uint64(0x9E3779B97F4A7C15)


def packed(numbers: np.ndarray) -> bytes:
    """Bytes of the numbers, all first bytes, then all second ones...: equal bytes stand together."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T).tobytes()


def unpacked(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(width, len(data) // width).T).view(kind).ravel()


def packed_counts(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold the largest of them; the width comes first."""
    top = int(counts.max()) if len(counts) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return bytes([width]) + packed(counts.astype(f"<u{width}"))


def unpacked_counts(data: bytes) -> np.ndarray:
    return unpacked(data[1:], f"<u{data[0]}").astype(np.uint64)


class Batch:
    """The n-grams of a batch of documents, as one row of tokens with start marks between texts."""

    def __init__(self, texts: list[bytes], order: int):
        self.order = order
        pad = order - 1
        hashes, sizes = [], []
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        for lo, hi in slices(lengths, 1 << 20):
            words: list[bytes] = []
            for text in texts[lo:hi]:
                before = len(words)
                words += text.translate(LOWER).split()
                words.append(END)
                sizes.append(len(words) - before)
            column = pa.array(words, type=pa.binary()).dictionary_encode()
            own = np.array([xxhash.xxh64_intdigest(w.as_py()) for w in column.dictionary], dtype=np.uint64)
            hashes.append(own[column.indices.to_numpy()])
        self.sizes = np.array(sizes, dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes + pad)[:-1]]).astype(np.int64) + pad
        total = int(self.sizes.sum()) + pad * len(texts)
        tokens = np.full(total, START, dtype=np.uint64)
        self.is_token = np.ones(total, dtype=bool)
        for k in range(1, pad + 1):
            self.is_token[self.first - k] = False
        tokens[self.is_token] = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), self.sizes + pad)
        # keys[k][p]: the n-gram of k + 1 tokens that ends at p.
        self.keys = [tokens]
        for _ in range(1, order):
            longer = self.keys[-1].copy()
            longer[1:] = (self.keys[-1][:-1] * MIX ^ (self.keys[-1][:-1] >> np.uint64(31))) + tokens[1:]
            self.keys.append((longer ^ longer >> np.uint64(29)) * MIX)
        # The last start mark of a text ends the first token's contexts.
        self.marks = self.first - 1

    def requests(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(order, places, keys): order 0 holds contexts that end in a start mark."""
        places = np.flatnonzero(self.is_token)
        out = [(k + 1, places, keys[places]) for k, keys in enumerate(self.keys)]
        if self.order > 1:
            out.append((0, self.marks, np.concatenate([k[self.marks] for k in self.keys[:-1]])))
        return out


def dealt(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Documents with their batch and whether they train, and the number of buckets. Batches whose
    number DELETED divides hold the deleted documents."""
    source = records(docs, id_col, text_col).withColumn("text", F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = tasks(docs.sparkSession)

    def drawn(seed: int, parts: int) -> Column:
        return F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(parts))

    # A text's own hash deletes it, at any number of batches; the deleted have batches of their own.
    rounds = -(-max(least, -(-size // BATCH_BYTES)) // DELETED)
    turn = F.when(drawn(1, DELETED) == 0, 0).otherwise(drawn(2, DELETED - 1) + 1)
    learned = fold(F.col("doc_id"), LEARN_FOLDS) != 0
    return source.select(
        "doc_id", "text", (drawn(3, rounds) * DELETED + turn).cast("long").alias("batch"), learned.alias("learned"),
    ), max(least, -(-size // BUCKET_BYTES))


def asked(docs: DataFrame, order: int, buckets: int) -> DataFrame:
    """(order, bucket, batch, keys, seen): what batches have of each n-gram."""
    def run(table: pa.Table) -> pa.Table:
        batch = table["batch"][0].as_py()
        own = Batch(table["text"].to_pylist(), order)
        learned = table["learned"].to_numpy()
        rows = []
        for level, places, keys in own.requests():
            weight = learned[own.doc[places]]
            if level == 0:
                weight = np.tile(weight, own.order - 1)
            keys, inverse = np.unique(keys, return_inverse=True)
            seen = np.bincount(inverse, weights=weight, minlength=len(keys)).astype(np.uint64)
            bucket = bucket_of(keys, buckets)
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(keys)]):
                if hi > lo:
                    rows.append((level, int(bucket[lo]), batch, packed(keys[lo:hi]), packed_counts(seen[lo:hi])))
        return as_table(rows, ["order", "bucket", "batch", "keys", "seen"])

    return docs.groupBy("batch").applyInArrow(
        run, "order long, bucket long, batch long, keys binary, seen binary")


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the keys, so that a batch's sorted keys fall into buckets in order."""
    return (keys >> np.uint64(32)).astype(np.int64) * buckets >> 32


def as_table(rows: list[tuple], names: list[str]) -> pa.Table:
    kinds = [pa.binary() if n in ("keys", "seen", "all", "kept") else pa.int64() for n in names]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table([pa.array(c, type=t) for c, t in zip(columns, kinds)], names=names)


def answered(requests: DataFrame) -> DataFrame:
    """The totals of each request's n-grams, in the request's order, and for a deleted batch also
    those without the deleted; one more row a bucket, with batch null, has the number of types
    and tokens of order 1 (of all, and without the deleted)."""
    names = ["order", "bucket", "batch", "all", "kept", "types", "tokens", "kept_types", "kept_tokens"]

    def run(table: pa.Table) -> pa.Table:
        order, bucket = table["order"][0].as_py(), table["bucket"][0].as_py()
        keys = [unpacked(k.as_py(), "<u8") for k in table["keys"]]
        unique, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        seen = np.concatenate([unpacked_counts(c.as_py()) for c in table["seen"]])
        deleted = np.repeat(table["batch"].to_numpy() % DELETED == 0, [len(k) for k in keys])
        whole, kept = (np.bincount(inverse, weights=w, minlength=len(unique)).astype(np.uint64) for w in (seen, seen * ~deleted))
        rows, at = [], 0
        for batch, own in zip(table["batch"].to_pylist(), keys):
            part = inverse[at:at + len(own)]
            at += len(own)
            without = packed_counts(kept[part]) if batch % DELETED == 0 else None
            rows.append((order, bucket, batch, packed_counts(whole[part]), without, 0, 0, 0, 0))
        if order == 1:
            rows.append((order, bucket, None, None, None, int((whole > 0).sum()), int(whole.sum()),
                         int((kept > 0).sum()), int(kept.sum())))
        return as_table(rows, names)

    return requests.groupBy("order", "bucket").applyInArrow(run, (
        "order long, bucket long, batch long, all binary, kept binary, types long, tokens long, "
        "kept_types long, kept_tokens long"))


def counts_of(own: Batch, answers: pa.Table, held_out: bool) -> list[np.ndarray]:
    """For each order the count of the n-gram that ends at each place, with or without the deleted."""
    column = "kept" if held_out else "all"
    out = [np.zeros(len(own.is_token)) for _ in own.keys]
    answers = answers.select(["order", "bucket", column]).sort_by([("order", "ascending"), ("bucket", "ascending")])
    orders = answers["order"].to_numpy()
    for level, places, keys in own.requests():
        _, inverse = np.unique(keys, return_inverse=True)
        mine = answers.filter(pa.array(orders == level))
        found = np.concatenate([unpacked_counts(c.as_py()) for c in mine[column]])[inverse].astype(float)
        if level:
            out[level - 1][places] = found
        else:
            for k in range(own.order - 1):
                out[k][places] = found[k * len(places):(k + 1) * len(places)]
    return out


def estimates(own: Batch, counts: list[np.ndarray], types: int, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the longest context, estimates): uniform first, then a column for each order."""
    places = np.flatnonzero(own.is_token)
    columns = [np.full(len(places), 1 / (types + 1)), counts[0][places] / max(tokens, 1)]
    longest = np.full(len(places), float(tokens))
    for k in range(1, own.order):
        longest = counts[k - 1][places - 1]
        columns.append(np.divide(counts[k][places], longest, out=np.zeros(len(places)), where=longest > 0))
    bucket = np.where(longest > 0, np.floor(np.log2(np.maximum(longest, 1))) + 1, 0).astype(np.int64)
    return np.minimum(bucket, CONTEXT_BUCKETS - 1), np.stack(columns, axis=1)


def with_answers(docs: DataFrame, answers: DataFrame, column: str, run: Callable, schema: str) -> DataFrame:
    named = answers.filter("batch IS NOT NULL").select("batch", "order", "bucket", column)
    return docs.groupBy("batch").cogroup(named.groupBy("batch")).applyInArrow(run, schema)


def deleted_tokens(docs: DataFrame, answers: DataFrame, order: int, types: int, tokens: int) -> DataFrame:
    """The deleted documents' tokens on a grid: (bucket, one cell number for each order), their
    number and the sums of their estimates. A cell is a sixteenth of a decade wide, and 0 holds zero."""
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        # The answers are for the n-grams of all the batch's documents, training or not.
        own = Batch(table["text"].to_pylist(), order)
        bucket, columns = estimates(own, counts_of(own, replies, held_out=True), types, tokens)
        learned = table["learned"].to_numpy()[own.doc[own.is_token]]
        bucket, columns = bucket[learned], columns[learned]
        cell = np.zeros(len(bucket), dtype=np.int64)
        for k in range(1, order + 1):
            step = np.where(columns[:, k] > 0, np.round(np.log10(np.maximum(columns[:, k], 1e-15)) * 16) + 241, 0)
            cell = cell * 256 + step.astype(np.int64)
        both, inverse = np.unique(np.stack([bucket, cell]), axis=1, return_inverse=True)
        sums = [np.bincount(inverse, weights=columns[:, k], minlength=both.shape[1]).astype(float) for k in range(1, order + 1)]
        number = np.bincount(inverse, minlength=both.shape[1]).astype(float)
        names = ["bucket", "cell", "n", *[f"sum{k}" for k in range(order)]]
        return pa.table([pa.array(both[0]), pa.array(both[1]), pa.array(number), *map(pa.array, sums)], names=names)

    sums = ", ".join(f"sum{k} double" for k in range(order))
    cells = with_answers(docs, answers, "kept", run, f"bucket long, cell long, n double, {sums}")
    return cells.groupBy("bucket", "cell").agg(F.sum("n").alias("n"), *[F.sum(f"sum{k}").alias(f"sum{k}") for k in range(order)])


def learn_weights(cells: list, order: int, uniform: float, rounds: int = 50) -> np.ndarray:
    """Mixture weights by context bucket (row) and order (column, uniform first), by EM.

    A bucket without held-out tokens takes the next lower bucket's weights; unseen contexts
    (bucket 0) have none for the longest order.
    """
    weights = np.full((CONTEXT_BUCKETS, order + 1), 1 / (order + 1))
    by: dict[int, list] = {}
    for c in cells:
        by.setdefault(c["bucket"], []).append([c["n"], *[c[f"sum{k}"] / c["n"] for k in range(order)]])
    for b in range(CONTEXT_BUCKETS):
        if b not in by:
            weights[b] = weights[b - 1] if b > 1 else weights[b]
        else:
            data = np.array(by[b])
            n, estimate = data[:, 0], np.column_stack([np.full(len(data), uniform), data[:, 1:]])
            mix = weights[b]
            for _ in range(rounds):
                part = estimate * mix
                mix = (part / part.sum(axis=1, keepdims=True) * n[:, None]).sum(axis=0) / n.sum()
            # The uniform part never vanishes, so that no token is impossible.
            weights[b] = np.maximum(mix, 1e-6) / np.maximum(mix, 1e-6).sum()
        if b == 0 and order > 1:
            weights[0, -1] = 0
            weights[0] /= weights[0].sum()
    return weights


def score_texts(docs: DataFrame, order: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (the text's log10 probability).

    Learns from the documents whose crc32(doc_id as text) mod 10 is not 0. Words are split at
    ASCII white space and lower-cased A-Z; an end follows each text. A null or empty text is
    its end alone. Repeated rows count and are scored each (equal ones in one batch). Very long
    texts are whole in a batch of their own size. Without training documents all estimates but
    the uniform one are zero; an empty table gives no rows.
    """
    source, buckets = dealt(docs, id_col, text_col)
    answers = written(answered(asked(source, order, buckets)), "ngram-counts")
    size = answers.filter("batch IS NULL").agg(*[
        F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("types", "tokens", "kept_types", "kept_tokens")]).first()
    tenth = source.filter(F.col("batch") % DELETED == 0), answers.filter(F.col("batch") % DELETED == 0)
    # The grid bounds what comes to the driver, whatever the corpus holds.
    cells = deleted_tokens(*tenth, order, size["kept_types"], size["kept_tokens"]).collect()
    weights = learn_weights(cells, order, 1 / (size["kept_types"] + 1))
    types, tokens = size["types"], size["tokens"]
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        own = Batch(table["text"].to_pylist(), order)
        counts = counts_of(own, replies, held_out=False)
        bucket, columns = estimates(own, counts, types, tokens)
        starts = np.concatenate([[0], np.cumsum(own.sizes)[:-1]])
        known = counts[0][own.is_token]
        base = np.log10((known + BASE_ADD) / (tokens + BASE_ADD * (types + 1)))
        score = np.log10((columns * weights[bucket]).sum(axis=1))
        return pa.table([
            table["doc_id"], table["learned"], pa.array(own.sizes),
            pa.array(np.add.reduceat((known > 0).astype(np.int64), starts)),
            pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(score, starts)),
        ], names=["doc_id", "learned", "n_tokens", "n_known", "base_score", "score"])

    scored = with_answers(source, answers, "all", run, (
        f"doc_id {kind}, learned boolean, n_tokens long, n_known long, base_score double, score double"))
    return scored.select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
