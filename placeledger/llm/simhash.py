"""Near duplicates by SimHash, compared bit-sliced.

A text's fingerprint has a bit set where more than half of its shingles' hashes have it.
Two texts are linked when their fingerprints differ in at most `radius` bits.

Equal fingerprints are folded first. 64 bits are cut into radius + 2 blocks; two
fingerprints within the radius agree in at least two blocks, so each pair of blocks is a
bucket key and no link is lost. In a bucket the fingerprints stand as vertical bit planes
(one word holds one bit of 64 fingerprints); a query's bit is XORed with a whole plane and
the differences are added by carry-save counters, 64 distances at a time, until all
counters of the word have run over the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from placeledger.llm.common import hot_free_join, records, smallest_reachable, written
from placeledger.operators.identity import connected_components

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SEED = 42
TILE = 512
CHUNK = 8192
# Links that a task folds at once.
STARS = 1 << 20
NO_WORD = np.uint64(0)
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 values of all shingles, repeats included; fewer words than a shingle are the one."""
    tokens = (text or "").encode().translate(LOWER).split()
    if not tokens:
        return np.zeros(0, dtype="<u8")
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in shingles], dtype="<u8")


def reseeded(hashes: np.ndarray, seed: int) -> np.ndarray:
    """The hashes as another hash function would give them (splitmix64); seed 0 leaves them."""
    if not seed:
        return hashes
    x = hashes + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words: int) -> int:
    """Majority bits of the XXH64 values of all shingles, repeats included."""
    return majority(shingle_hashes(text, words))


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. Null and wordless texts have 0."""
    source = records(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), words) for t in batch.column("text")], dtype="<u8")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view("<i8"))], ["doc_id", "fp"])

    return source.mapInArrow(run, f"doc_id {kind}, fp long")


def planes_of(codes: np.ndarray) -> np.ndarray:
    """Vertical planes: row b holds bit b of all codes, 64 codes to a word."""
    padded = np.concatenate([codes, np.zeros(-len(codes) % 64, dtype="<u8")])
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within_radius(
    queries: np.ndarray, planes: np.ndarray, radius: int, open_pairs: np.ndarray | None = None, bits: int = (1 << 64) - 1,
) -> tuple[np.ndarray, int]:
    """Bit matrix (query x word): set where a stored code differs in at most `radius` of the `bits`,
    among the pairs set in `open_pairs` (all of them by default); and the planes read, added up
    over the words they were read for.

    The counters start so that they run over at radius + 1 differences. A word is given up as
    soon as all its counters are over or were never open.
    """
    width = int(radius + 1).bit_length() if radius else 1
    start = (1 << width) - 1 - radius
    over = np.zeros((len(queries), planes.shape[1]), dtype="<u8") if open_pairs is None else ~open_pairs
    near, steps = np.zeros_like(over), 0
    row, word = np.nonzero(over != ALL)
    over = over[row, word]
    counter = [np.full(len(row), ALL if start >> k & 1 else NO_WORD) for k in range(width)]
    for done, bit in enumerate(k for k in range(64) if bits >> k & 1):
        if done % 4 == 0:
            live = over != ALL
            if live.sum() * 4 < len(live) * 3:
                row, word, over = row[live], word[live], over[live]
                counter = [c[live] for c in counter]
        if not len(row):
            break
        wanted = np.where(queries >> np.uint64(bit) & np.uint64(1), ALL, NO_WORD)
        carry = planes[bit][word] ^ wanted[row]
        for k in range(width):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over |= carry
        steps += len(row)
    near[row, word] = ~over
    return near, steps


def near_blocks(
    left: np.ndarray, right: np.ndarray, radius: int, first: np.ndarray, end: np.ndarray, bits: int = (1 << 64) - 1,
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pairs of codes within the radius, block by block: where the block begins in left and in
    right, and the indexes inside it. Left code i is compared with right codes first[i] to end[i]."""
    for b in range(0, len(right), 4096):
        planes = planes_of(right[b:b + 4096])
        place = np.arange(planes.shape[1] * 64) + b
        for a in range(0, len(left), TILE):
            lo, hi = first[a:a + TILE, None], np.minimum(end[a:a + TILE, None], len(right))
            if (hi <= b).all() or (lo >= b + 4096).all():
                continue
            open_pairs = np.packbits((place >= lo) & (place < hi), axis=1, bitorder="little").view("<u8")
            near, _ = within_radius(left[a:a + TILE], planes, radius, open_pairs, bits)
            if near.any():
                yield a, b, *np.nonzero(np.unpackbits(near.view(np.uint8), axis=1, bitorder="little"))


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (into left, into right) of all codes within the radius."""
    every = np.zeros(len(left), dtype=np.int64), np.full(len(left), len(right))
    none = np.zeros(0, dtype=int)
    found = [(none, none), *((i + a, j + b) for a, b, i, j in near_blocks(left, right, radius, *every))]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def bucket_links(bucket: np.ndarray, side: np.ndarray, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal `bucket` (sorted), as stars around each group's first row.

    Small runs share a tile of planes. Rows of a run have side 0, or sides 0 and 1 when
    two chunks of a large bucket meet; then only rows of different sides are compared. Of two
    rows one is compared with the other, and only inside a run; bits that all rows of a run
    share, as those of its key, are not read.
    """
    ends = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket))
    starts = np.append(0, ends[:-1])
    differ = np.bitwise_or.reduceat(codes ^ np.repeat(codes[starts], ends - starts), starts) if len(codes) else codes
    run_end = np.repeat(ends, ends - starts)
    lefts, rights = [], []

    def compare(lo: int, hi: int, bits: int) -> None:
        own = side[lo:hi]
        crossing = bool(own.any())
        a = np.flatnonzero(own == 0)
        b = np.flatnonzero(own == 1) if crossing else a
        first = np.zeros(len(a), dtype=np.int64) if crossing else a + 1
        last = np.full(len(a), len(b)) if crossing else run_end[lo:hi] - lo
        found = [(a[:0], a[:0])]
        for at, beside, i, j in near_blocks(codes[lo:hi][a], codes[lo:hi][b], radius, first, last, bits):
            # Only what joins the block's groups is kept, never all its pairs.
            both = np.concatenate([a[at:at + TILE], b[beside:beside + 4096]])
            root = smallest_reachable(len(both), i, j + len(a[at:at + TILE]))
            moved = np.flatnonzero(root != np.arange(len(both)))
            found.append((both[moved], both[root[moved]]))
        root = smallest_reachable(hi - lo, *(np.concatenate(e) for e in zip(*found)))
        moved = np.flatnonzero(root != np.arange(hi - lo))
        lefts.append(moved + lo)
        rights.append(root[moved] + lo)

    begin = previous = bits = 0
    for end, own_bits in zip(ends.tolist(), differ.tolist()):
        crossing = bool(side[previous:end].any())
        if previous > begin and (crossing or end - begin > TILE):
            compare(begin, previous, bits)
            begin, bits = previous, 0
        bits |= own_bits
        if crossing:
            compare(previous, end, bits)
            begin, bits = end, 0
        previous = end
    if begin < len(bucket):
        compare(begin, len(bucket), bits)
    if not lefts:
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    return np.concatenate(lefts), np.concatenate(rights)


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as a-b, one a node, to the smallest that it can reach."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = smallest_reachable(len(nodes), places[:len(a)], places[len(a):])
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def bucket_keys(radius: int) -> list[tuple[int, int]]:
    """(mask, number) of each pair of the radius + 2 blocks of the 64 bits."""
    cuts = [round(64 * k / (radius + 2)) for k in range(radius + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    masks = [a | b for a, b in combinations(blocks, 2)]
    return [(m - (1 << 64) if m >> 63 else m, n) for n, m in enumerate(masks)]


def links(codes: DataFrame, radius: int = 3, chunk: int = CHUNK, node: str = "fp", within: tuple[str, ...] = ()) -> DataFrame:
    """(a, b): links between different nodes (longs; by default the fingerprints themselves),
    enough of them to join all whose fingerprints in column `fp` are within the radius,
    directly or through others. Only rows that agree in the columns `within` are compared.

    A bucket with more than `chunk` fingerprints is cut into chunks, and every two of its
    chunks meet in a task of their own.
    """
    keys = F.explode(F.array(*[
        F.struct(F.lit(n).alias("n"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for m, n in bucket_keys(radius)
    ])).alias("key")
    dealt = codes.select(F.col(node).alias("node"), "fp", *within, keys).select(
        "node", "fp", F.xxhash64(*within, "key.n", "key.part").alias("bucket"))
    filled = dealt.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    rows = hot_free_join(dealt, filled, "bucket").withColumn("chunks", F.ceil(F.col("members") / chunk).cast("int"))
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("chunks")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda x: F.struct(
        F.least(F.col("own"), x).alias("low"), F.greatest(F.col("own"), x).alias("high"),
        F.when(F.col("own") > x, 1).otherwise(0).alias("side"),
    ))
    # Equal hashes of different keys only put more rows side by side; distances decide.
    tiles = rows.withColumn("own", own).select("bucket", "node", "fp", F.inline(meets)).select(
        F.xxhash64("bucket", "low", "high").alias("bucket"), "side", "node", "fp",
    )
    # The first row of a run is its smallest node, so buckets that share members share their stars.
    ordered = tiles.repartition("bucket").sortWithinPartitions("bucket", "side", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.int64)
        found, held = (none, none), None

        def add(table: pa.Table) -> None:
            nonlocal found
            code, nodes = table["fp"].to_numpy().view("<u8"), table["node"].to_numpy()
            i, j = bucket_links(table["bucket"].to_numpy(), table["side"].to_numpy(), code, radius)
            found = np.concatenate([found[0], nodes[i]]), np.concatenate([found[1], nodes[j]])
            if len(found[0]) >= STARS:
                found = stars(*found)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in stars(*found)], ["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            last = held["bucket"][-1].as_py()
            keys_here = held["bucket"].to_numpy()
            cut = int(np.searchsorted(keys_here, last))
            if cut >= TILE:
                add(held.slice(0, cut).combine_chunks())
                held = held.slice(cut)
                if len(found[0]) >= STARS:
                    yield out()
                    found = (none, none)
        if held is not None and len(held):
            add(held.combine_chunks())
        yield out()

    return ordered.mapInArrow(run, "a long, b long").distinct()


def simhash_components(
    docs: DataFrame, radius: int = 3, words: int = 3, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest
    doc_id it is linked with, directly or through others; itself included).

    Null, empty and wordless texts have fingerprint zero and are linked like any other.
    Fewer words than a shingle: all of them are the one shingle. Repeated rows stay, one
    result each. A null doc_id is no member of the minimum: its row takes the group's
    smallest id, null if the group has no other. Very long texts count with all their shingles,
    one document at a time. An empty table gives no rows.
    """
    prints = written(fingerprints(docs, words, id_col, text_col), "simhash")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    classes = written(classes, "simhash-classes")
    pairs = written(links(classes.select("fp"), radius), "simhash-links")
    named = connected_components(pairs).withColumnsRenamed({"node": "fp", "component": "root"})
    # A fingerprint without links is its own root.
    rooted = classes.join(named, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = written(rooted, "simhash-roots")
    lowest = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    component = hot_free_join(rooted.select("fp", "root"), lowest, "root").select("fp", "component_id")
    return hot_free_join(prints, component, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )
