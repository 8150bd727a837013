"""Near copies by the Jaccard similarity of their word shingles, found through SimHash.

Texts with the same set of shingles are one class. Candidates come from several fingerprints
a class, seeded independently: one within the radius is enough. They only make groups, and a
pass over some fingerprints meets the groups of the passes before it as one node each. Inside
a group classes are compared by their shingle sets, and a link is kept only where the
similarity is reached. So no wrong link stays, and what can be missed is a pair that lies
beyond the radius in all fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from placeledger.llm.common import hot_free_join, records, smallest_reachable, text_slices, written
from placeledger.llm.simhash import links, majority, reseeded, shingle_hashes
from placeledger.operators.identity import connected_components

SHINGLE = 5
SIMILARITY = 0.8
PRINTED = 3
SEEDS = 8
# Fingerprints a class that are compared in one pass: bounds what lies on disk at once.
SEEDS_A_PASS = 2
# Shingles, and a hundred a text, that one side of a tile holds.
TILE_SHINGLES = 1 << 20


def shingle_set(text: str | None, words: int = SHINGLE) -> np.ndarray:
    return np.unique(shingle_hashes(text, words))


def printed(docs: DataFrame, seeds: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, cls, size, fps): digest and size of the text's shingle set, and its fingerprints."""
    source = records(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, fps = [], [], []
            for texts in text_slices(batch.column("text")):
                for text in texts:
                    own, hashes = shingle_set(text), shingle_hashes(text, PRINTED)
                    digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                    sizes.append(len(own))
                    fps.append([majority(reseeded(hashes, s)) for s in range(seeds)])
            signed = pa.array(np.array(fps, dtype="<u8").reshape(-1).view("<i8"))
            ends = pa.array(np.arange(len(fps) + 1, dtype=np.int32) * seeds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()),
                 pa.ListArray.from_arrays(ends, signed)], ["doc_id", "cls", "size", "fps"])

    return source.mapInArrow(run, f"doc_id {kind}, cls binary, size int, fps array<long>")


def places(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each run, one run after the other."""
    return np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())


def similar_groups(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For sets of distinct numbers: the smallest set each is joined with by pairs whose Jaccard
    similarity is `similarity` or more.

    Each set is compared with those that no group has yet, which lie under their numbers;
    the lists are made anew when half of them are placed, so a large group of copies costs
    little more than its size.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    root = np.full(len(sets), -1)
    members = counts = starts = known = np.zeros(0, dtype=np.int64)
    held = 0
    for first in range(len(sets)):
        if root[first] >= 0:
            continue
        root[first] = first
        waiting = [first]
        while waiting:
            own = sets[waiting.pop()]
            left = np.flatnonzero(root < 0)
            if not len(left):
                break
            if not held or len(left) * 2 <= held:
                held = len(left)
                values = np.concatenate([sets[k] for k in left])
                order = np.argsort(values, kind="stable")
                members = np.repeat(left, sizes[left])[order]
                known, starts, counts = np.unique(values[order], return_index=True, return_counts=True)
            at = np.searchsorted(known, own)
            at = at[np.append(known, own[:1])[at] == own] if len(known) else at[:0]
            at = at[at < len(known)]
            met, shared = np.unique(members[places(starts[at], counts[at])], return_counts=True)
            near = (root[met] < 0) & (shared + 1e-9 >= similarity * (len(own) + sizes[met] - shared))
            root[met[near]] = first
            waiting.extend(met[near].tolist())
    return root


def tile_links(table: pa.Table, similarity: float) -> pa.Table:
    """(a, b): the classes of a tile, each with the smallest node it is joined with."""
    node, first = np.unique(table["node"].to_numpy(), return_index=True)
    text = table["text"].combine_chunks().take(pa.array(first))
    sets = [shingle_set(t) for texts in text_slices(text) for t in texts]
    root = similar_groups(sets, similarity)
    moved = np.flatnonzero(root != np.arange(len(node)))
    return pa.table([pa.array(node[moved]), pa.array(node[root[moved]])], names=["a", "b"])


def verified(members: DataFrame, similarity: float, tile: int) -> DataFrame:
    """(a, b): links between similar classes of one component, enough of them to join all.

    A component with more than `tile` shingles is cut into chunks, each with the component's
    first class beside it. What a chunk joins with that one needs no other link; only the rest
    is compared with all the chunks, a chunk of the rest and one of all in a task.
    """
    def met(tiles: DataFrame) -> DataFrame:
        return written(tiles.groupBy("component", "low", "high").applyInArrow(
            lambda table: tile_links(table.select(["node", "text"]), similarity), "a long, b long"), "copy-links")

    def chunked(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("component").agg(F.ceil(F.sum(F.col("size") + 100) / tile).cast("int").alias(name))

    def own(count: str) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(7)), F.col(count)).cast("int")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    sized = hot_free_join(members, chunked(members, "chunks"), "component")
    zero = F.lit(0)
    # A component is named by its smallest node.
    first = sized.filter("node = component").select("component", "node", "text", zero.alias("low"), each("chunks").alias("high"))
    rest = sized.filter("node <> component").select("component", "node", "text", zero.alias("low"), own("chunks").alias("high"))
    links = met(first.unionByName(rest))
    joined = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    loose = sized.filter("chunks > 1 AND node <> component").select("component", "node", "size", "chunks").join(
        joined, ["node", "component"], "left_anti")
    loose = written(loose, "copy-loose")
    waiting = written(chunked(loose, "blocks"), "copy-waiting")
    loose = members.select("node", "text").join(loose, "node")
    low = hot_free_join(loose, waiting, "component").select(
        "component", "node", "text", own("blocks").alias("low"), each("chunks").alias("high"))
    high = hot_free_join(sized, waiting, "component").select(
        "component", "node", "text", each("blocks").alias("low"), own("chunks").alias("high"))
    return links.unionByName(met(low.unionByName(high)))


def first_copies(
    docs: DataFrame, radius: int, similarity: float = SIMILARITY, seeds: int = SEEDS, tile: int = TILE_SHINGLES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id): the smallest id of each group of near copies; texts without copies are groups.

    Two texts are linked when their five-word shingles (ASCII lower case, words between blanks)
    have a Jaccard similarity of `similarity` or more and one of `seeds` fingerprints of each
    differ in at most `radius` bits, directly or through others. Texts of fewer than five words
    have all their words as the one shingle; null, empty and wordless texts are one group.
    Repeated rows are one class; ids may be of any ordered type, and of rows that share one all
    texts count. Very long texts are read whole, one at a time. An empty table gives no rows.
    """
    rows = printed(docs, seeds, id_col, text_col).groupBy("cls").agg(
        F.min("doc_id").alias("first_doc"), F.any_value("size").alias("size"), F.any_value("fps").alias("fps"))
    classes = written(rows.withColumn("node", F.monotonically_increasing_id()), "copy-classes")
    # Wordless texts are one class, and like no other.
    rooted = classes.filter("size > 0").select("node", F.col("node").alias("root"))
    for s in range(0, seeds, SEEDS_A_PASS):
        codes = classes.select("node", F.posexplode("fps").alias("seed", "fp")).filter(
            (F.col("seed") >= s) & (F.col("seed") < s + SEEDS_A_PASS))
        grouped = codes.join(rooted, "node").select("root", "seed", "fp").distinct()
        pairs = written(links(grouped, radius, node="root", within=("seed",)), "copy-candidates")
        named = written(connected_components(pairs), "copy-groups").withColumnRenamed("node", "root")
        rooted = written(hot_free_join(rooted, named, "root", "left").select(
            "node", F.coalesce("component", "root").alias("root")), "copy-roots")
    crowds = rooted.groupBy("root").agg(F.count("*").alias("nodes")).filter("nodes > 1")
    groups = hot_free_join(rooted, crowds, "root").select("node", F.col("root").alias("component"))
    members = classes.select("node", "first_doc", "size").join(groups, "node")
    # Equal rows have one id here; one of them is enough.
    texts = records(docs, id_col, text_col).withColumnRenamed("doc_id", "first_doc")
    members = hot_free_join(texts, members, "first_doc").dropDuplicates(["node"])
    members = written(members.select("node", "component", "size", "text"), "copy-members")
    named = connected_components(verified(members, similarity, tile)).withColumnsRenamed({"component": "root"})
    rooted = classes.select("node", "first_doc").join(named, "node", "left")
    return rooted.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first_doc").alias("doc_id")).select("doc_id")
