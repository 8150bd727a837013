"""Identity of sightings that arrive in batches, against a stored index of their keys.

An entity is named by the smallest seq of its sightings so far. Stored are the index (one row a
key: the entity that has it, in buckets of the key), the sightings' entities as they were
decided, and renames: an entity that turned out to be one with another, for instance because a
new sighting shares a key with both, points at the one with the smaller name. So a batch reads
and rewrites the index buckets of its own keys only, whatever is known already, and the batches
together give the components that one batch of everything would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from placeledger.operators.identity import connected_components, with_keys
from placeledger.operators.joins import lookup
from placeledger.session import cut_lineage
from placeledger.sources.buckets import create_table, merge_batch, rows_like
from placeledger.sources.sinks import read_snapshot, write_snapshot


def create_index(spark: SparkSession, root: str, buckets: int = 64) -> None:
    """An index that knows no entity."""
    create_table(spark.createDataFrame([], "key string, entity bigint"), f"{root}/keys", ["key"], buckets)
    write_snapshot(spark.createDataFrame([], "entity bigint, now bigint"), f"{root}/renames")


def renamed(entities: DataFrame, renames: DataFrame) -> DataFrame:
    """`entities` with column `entity` brought up to date."""
    return lookup(entities, renames, "entity", "left", broadcast=False).withColumn("entity", F.coalesce("now", "entity")).drop("now")


def resolve_next(obs: DataFrame, root: str, name: str) -> DataFrame:
    """Add a batch of sightings and return its bridges: entity (known until now), now (its name
    from now on), one row for each known entity that became one with another or has a sighting
    with a smaller seq.

    `obs` has the identity columns and a `seq` that no other sighting of any batch has. `name` is the batch's: a
    replay overwrites its own output and gives the same entities. Sightings without a
    key are entities of their own. Repeated keys are folded to one edge a sighting. Joins are by
    sorting, whatever their sides' sizes: batch after batch, broadcasts would add up on the driver.
    """
    spark = obs.sparkSession
    keyed = cut_lineage(with_keys(obs).select("seq", F.inline_outer("keys")).select("seq", "key"))
    linked = keyed.filter("key IS NOT NULL")
    hubs = cut_lineage(linked.groupBy("key").agg(F.min("seq").alias("hub")))
    renames = read_snapshot(spark, f"{root}/renames")
    known = cut_lineage(renamed(rows_like(spark, f"{root}/keys", hubs), renames))
    edges = lookup(linked, hubs, "key", broadcast=False).select(F.col("seq").alias("a"), F.col("hub").alias("b")).unionByName(
        known.join(hubs.hint("merge"), "key").select(F.col("hub").alias("a"), F.col("entity").alias("b")))
    components = cut_lineage(connected_components(edges))
    alone = F.coalesce("component", "seq").alias("entity")
    members = lookup(keyed.select("seq").distinct(), components.withColumnRenamed("node", "seq"), "seq", "left", broadcast=False)
    members.select("seq", alone).write.mode("overwrite").parquet(f"{root}/members/batch={name}")
    moved = cut_lineage(known.select("entity").distinct().join(components.withColumnsRenamed(
        {"node": "entity", "component": "now"}).hint("merge"), "entity").filter("entity <> now"))
    # Renames point at today's names, never at one another.
    onward = renames.withColumnsRenamed({"entity": "first", "now": "entity"})
    write_snapshot(cut_lineage(renamed(onward, moved).select(F.col("first").alias("entity"), F.col("entity").alias("now")).unionByName(
        moved.select("entity", "now")).distinct()), f"{root}/renames")

    def merge(before: DataFrame, batch: DataFrame) -> DataFrame:
        both = before.select("key", "entity", F.lit(0).alias("age")).unionByName(batch.select("key", "entity", F.lit(1).alias("age")))
        return both.groupBy("key").agg(F.max_by("entity", "age").alias("entity"))

    fresh = hubs.join(components.hint("merge"), hubs["hub"] == components["node"]).select("key", F.col("component").alias("entity"))
    merge_batch(fresh, f"{root}/keys", merge, name)
    return moved


def resolved(spark: SparkSession, root: str) -> DataFrame:
    """(seq, component) of all sightings of all batches, as known now."""
    members = spark.read.parquet(f"{root}/members").select("seq", "entity")
    return renamed(members, read_snapshot(spark, f"{root}/renames")).select("seq", F.col("entity").alias("component"))
