"""Two-pass external shuffle into shards, in DataFrame operations only.

Pass one scatters records into buckets by seeded hashes: a shard by the largest of one hash
per shard (so one more shard takes rows only into itself), and inside the shard as many
buckets as its bytes need at `bucket_bytes` each, by a hash of id and text, so that rows that
share an id (or have none) spread over all of them. Pass two shuffles each bucket's
positions by Fisher-Yates (Spark's `shuffle`) and writes the records in that order.
Only positions are held in an array; the records themselves are sorted and can spill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from placeledger.llm.common import records, shuffles_freed, written
from placeledger.session import run_dir

SHARDS = 40
BUCKET_BYTES = 16 << 20
RECORD_BYTES = 16


def weights(shards: int, seed: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.xxhash64("doc_id", s, F.lit(seed)))


def scatter(docs: DataFrame, shards: int, bucket_bytes: int, seed: int) -> DataFrame:
    """`docs` with size, shard, grown_shard, bucket (inside the shard) and key (a hash)."""
    best = F.array_max("weights")
    dealt = docs.withColumn("weights", weights(shards, seed)).select(
        *docs.columns,
        (F.coalesce(F.octet_length("text"), F.lit(0)) + RECORD_BYTES).cast("long").alias("size"),
        (F.array_position("weights", best) - 1).cast("int").alias("shard"),
        (F.xxhash64("doc_id", F.lit(shards), F.lit(seed)) > best).alias("_moves"),
        F.xxhash64("doc_id", "text", F.lit(seed + 1)).alias("key"),
    )
    sums = dealt.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()
    parts = {r["shard"]: max(1, -(-r["bytes"] // bucket_bytes)) for r in sums}
    # One number for each shard: the number of shards bounds the list.
    needed = F.array(*[F.lit(parts.get(s, 1)) for s in range(shards)])
    return dealt.withColumns({
        "bucket": F.pmod("key", F.element_at(needed, F.col("shard") + 1)),
        "grown_shard": F.when(F.col("_moves"), shards).otherwise(F.col("shard")).cast("int"),
    }).drop("_moves")


def permutations(scattered: DataFrame, seed: int) -> DataFrame:
    """(shard, bucket, slots): the slots of a bucket's records by position, Fisher-Yates shuffled."""
    counts = scattered.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    slots = F.sequence(F.col("first"), F.col("first") + F.col("rows") - 1)
    # Written, so that no later step can see another permutation.
    return written(placed.select("shard", "bucket", F.shuffle(slots, F.lit(seed)).alias("slots")), "permutations")


def external_shuffle(
    docs: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every record with its place: doc_id, text, size, shard, slot (gapless from 0 in each
    shard), grown_shard (its shard if there was one shard more).

    The shard follows from doc_id and the number of shards alone. A null doc_id is an id
    like any other, so its rows share a shard but not a bucket; a null text has size 16. A
    very long text is a record like any other; its bucket may exceed `bucket_bytes` by it.
    Rows equal in id and text get a slot each, in one bucket; an empty table gives no rows.
    """
    scattered = scatter(records(docs, id_col, text_col), shards, bucket_bytes, seed)
    slots = permutations(scattered, seed)
    inside = Window.partitionBy("shard", "bucket").orderBy("key", "doc_id", "text")
    placed = scattered.withColumn("at", F.row_number().over(inside)).join(slots, ["shard", "bucket"])
    return placed.select("doc_id", "text", "size", "shard", F.element_at("slots", F.col("at")).alias("slot"), "grown_shard")


def write_shards(shuffled: DataFrame, path: str) -> None:
    """A folder per shard; each file holds whole buckets in slot order."""
    with shuffles_freed(shuffled.sparkSession):
        shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    return spark.read.schema(
        f"doc_id {id_type}, text string, size long, slot long, grown_shard int, shard int"
    ).parquet(path)


def shard_digests(docs: DataFrame, shards: int = SHARDS, **options) -> DataFrame:
    """Shuffle, write and read back: one row per record with the crc32 of its text (0: null)."""
    shuffled = external_shuffle(docs, shards, **options)
    path = run_dir(docs.sparkSession, "shards")
    write_shards(shuffled, path)
    stored = read_shards(docs.sparkSession, path, shuffled.schema["doc_id"].dataType.simpleString())
    return stored.select(
        "doc_id", "size", F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot", "grown_shard",
    )
