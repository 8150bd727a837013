"""Benchmark decontamination by size-partitioned MinHash containment search; in DataFrame
operations only.

A test item is its set of five-word shingles (an item of fewer words is its one sequence of all
of them); a document holds the item when it has at least `containment` of the set. Documents
are much longer than items, so only items are signed: an item's signature is its k lowest
hashes, k set by its size class (powers of two) as one more than the shingles the largest item
of the class may miss. Whatever part of an item a document holds, one of the k is in it, so the
search loses nothing. Documents look their shingles up in the classes whose items they are
large enough to hold; those with a hit are verified by counting the items' shingles, as texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from placeledger.llm.common import records, row_key, written

SHINGLE = 5
CONTAINMENT = 0.8
# Bytes in memory up to which signatures, or all items' shingles, are sent to every task; larger
# ones are joined by a shuffle. ROW_BYTES: a row's own and its share of a hash map.
BROADCAST_BYTES = 32 << 20
ROW_BYTES = 64


def words(text: str) -> Column:
    """Runs of letters and digits, lower-cased: case and punctuation do not hide a copy."""
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingled(df: DataFrame, lengths: list[int], *kept: str) -> DataFrame:
    """The kept columns, `words`, and one row per place `at` (from 1) of a shingle of `m` words."""
    spoken = df.select(*kept, words("text").alias("words")).filter(F.size("words") >= min(lengths))

    def places(m: int) -> Column:
        return F.sequence(F.lit(1), F.size("words") - (m - 1))

    if len(lengths) == 1:
        return spoken.select(*kept, "words", F.lit(lengths[0]).alias("m"), F.explode(places(lengths[0])).alias("at"))

    def every(m: int) -> Column:
        placed = F.transform(places(m), lambda at: F.struct(F.lit(m).alias("m"), at.alias("at")))
        return F.when(F.size("words") >= m, placed)

    return spoken.select(*kept, "words", F.inline(F.flatten(F.array_compact(F.array(*map(every, lengths))))))


def spelled() -> list[Column]:
    """A shingle's words; beyond its number of words null, which neither hash nor text sees."""
    return [F.when(F.col("m") > k, F.try_element_at("words", F.col("at") + k)) for k in range(SHINGLE)]


def shingle_hash() -> Column:
    return F.xxhash64("m", *spelled())


def shingle_text() -> Column:
    return F.concat_ws(" ", *spelled())


def needed(size: Column, containment: float) -> Column:
    """The shingles that must be found of an item of this size."""
    return F.ceil(size * containment - F.lit(1e-9))


def size_class(size: Column) -> Column:
    return F.floor(F.log2(size))


def signature_size(size: Column, containment: float) -> Column:
    """One more than the shingles that the largest item of the size class may miss."""
    largest = F.pow(F.lit(2), size_class(size) + 1) - 1
    return F.floor(largest * F.lit(round(1 - containment, 9)) + F.lit(1e-9)) + 1


def signatures(shingles: DataFrame, containment: float) -> DataFrame:
    """(hash, least): the lowest hashes of every item, once for all items that have one, and the
    fewest shingles that a document must have to hold an item of the smallest such class."""
    ranked = Window.partitionBy("item").orderBy("hash", "shingle")
    lowest = shingles.withColumn("rank", F.row_number().over(ranked)).filter(
        F.col("rank") <= signature_size(F.col("size"), containment))
    least = needed(F.pow(F.lit(2), size_class(F.col("size"))), containment)
    return lowest.groupBy("hash").agg(F.min(least).alias("least"))


def contained_items(
    docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT, broadcast_bytes: int = BROADCAST_BYTES,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document and test item it holds: doc_id, item_id, n_shingles (of the item),
    n_found, containment.

    Documents and items are told apart by id and text: rows that share an id are judged each by
    its own text, rows without an id are named by null, and equal rows are one. Null, empty and
    wordless texts hold nothing and are held by nothing. An item of fewer than five words is
    held where all its words follow each other. Very long texts are read whole. Ties in hashes
    are no matter: the shingles themselves decide. Clean documents have no row.
    """
    items = benchmark.select(row_key(item_col, item_text_col).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    spoken = items.filter("text IS NOT NULL").withColumn("m", F.least(F.size(words("text")), F.lit(SHINGLE))).filter("m > 0")
    lengths = sorted(r["m"] for r in spoken.select("m").distinct().collect())  # at most SHINGLE numbers
    lengths = lengths or [SHINGLE]
    # Every item has shingles of one length.
    own = shingled(spoken.withColumnRenamed("m", "own"), lengths, "item", "own").filter("m = own")
    own = own.select("item", "m", shingle_text().alias("shingle"), shingle_hash().alias("hash"))
    own = own.groupBy("item", "m", "shingle").agg(F.any_value("hash").alias("hash"))
    sizes = own.groupBy("item").agg(F.count("*").alias("size"))
    own = written(own.join(sizes, "item"), "item-shingles")
    lookup = written(signatures(own, containment), "item-signatures")
    weight = own.agg(F.sum(F.octet_length("shingle") + ROW_BYTES)).first()[0] or 0
    small, every = lookup.count() * ROW_BYTES <= broadcast_bytes, weight <= broadcast_bytes
    texts = records(docs, id_col, text_col).filter("text IS NOT NULL").withColumn("key", row_key())
    # Items that share a shingle share its one row here, so a document's place makes at most one.
    probe = shingled(texts, lengths, "key").select(
        "key", shingle_hash().alias("hash"), (F.size("words") - F.col("m") + 1).alias("places"))
    hits = probe.join(F.broadcast(lookup) if small else lookup, "hash").filter("places >= least")
    candidates = written(hits.select("key").distinct(), "candidate-documents")
    suspects = texts.join(candidates, "key", "left_semi")
    places = shingled(suspects, lengths, "key").select(
        "key", "m", shingle_hash().alias("hash"), shingle_text().alias("shingle"))
    named = own.select("hash", "m", "shingle", "item", "size")
    found = places.join(F.broadcast(named) if every else named, ["hash", "m", "shingle"])
    return found.select("key", "item", "size", "shingle").distinct().groupBy("key", "item", "size").agg(
        F.count("*").alias("n_found")).filter(F.col("n_found") >= needed(F.col("size"), containment)).select(
        F.col("key.id").alias("doc_id"), F.col("item.id").alias("item_id"), F.col("size").alias("n_shingles"), "n_found",
        (F.col("n_found") / F.col("size")).alias("containment"))
