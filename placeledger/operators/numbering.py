"""Consecutive numbers over a distributed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from placeledger.session import cut_lineage


def number_rows(df: DataFrame, name: str, *order: str, start: int = 0) -> DataFrame:
    """`df` with `name`: start, start + 1, ... in the order of the columns given.

    Rows are dealt to ranges of the order, sorted and counted there; only the counts, one a
    range, are added up in one place. The numbered rows are a table in the shared folder,
    so rows that tie keep their numbers for whoever reads them. The rows are written before
    they are dealt as well: the bounds of the ranges take a pass of their own, which would
    compute `df` a second time.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = cut_lineage(df).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    stored = cut_lineage(ordered.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("_range").agg(F.count("*").alias("_rows"))
    firsts = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    # The upper bits of the row number are the range's.
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    joined = stored.join(F.broadcast(firsts), "_range")
    return joined.withColumn(name, F.lit(start) + F.col("_first") + inside).drop("_range", "_at", "_rows", "_first")


def oldest_first(prefix: str, columns: list[str]) -> Column:
    """An order of stored rows that holds without ids: by id, those without one last, then
    by first sight. Never null, so no row drops out of a minimum."""
    parts = [F.col(f"{prefix}id").isNull(), F.col(f"{prefix}id")] if "id" in columns else []
    parts += [F.col(f"{prefix}{c}") for c in ("first_seen_at",) if c in columns]
    return F.struct(F.lit(0), *parts)


def with_ids(state: DataFrame, current: DataFrame, *order: str) -> DataFrame:
    """`state` where rows without an id get the numbers after the highest id of `current`, in
    the order given."""
    top = current.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("top")).first()["top"]
    # Only the new rows are written and numbered; the others stay a plan.
    fresh = number_rows(state.filter("id IS NULL").drop("id"), "id", *order, start=top + 1)
    return state.filter("id IS NOT NULL").unionByName(fresh.select(*state.columns))
