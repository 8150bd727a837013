"""Writers: versioned current state and report datasets."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from placeledger.session import list_names


def write_snapshot(df: DataFrame, root: str, version: str | None = None,
                   partition_by: list[str] | None = None) -> str:
    """Write a new version of a current-state table and make it the current one.

    Readers follow a one-row pointer table that is written last, so a job that dies
    half way leaves the previous version in place.
    """
    version = version or uuid.uuid4().hex
    target = f"{root}/version={version}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
    move_pointer(df.sparkSession, root, version)
    return version


def move_pointer(spark: SparkSession, root: str, version: str) -> None:
    """Make a version the current one. Pointers are numbered: clocks of different drivers
    have no say in which is the last."""
    known = list_names(spark, f"{root}/_pointers")
    number = versions(spark, root).agg(F.max("number")).first()[0] + 1 if known else 0
    pointer = spark.range(1).select(
        F.lit(version).alias("version"), F.current_timestamp().alias("written_at"), F.lit(number).cast("bigint").alias("number"))
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/_pointers")


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(version, written_at, number) of every version that was made current, one row each time."""
    stored = spark.read.schema("version string, written_at timestamp, number bigint").parquet(f"{root}/_pointers")
    # Pointers without a number are older than all that have one.
    return stored.withColumn("number", F.coalesce("number", F.lit(-1).cast("bigint")))


def current_version(spark: SparkSession, root: str) -> str:
    """The version made current last; raises when there is none yet."""
    return versions(spark, root).agg(F.max_by("version", F.struct("number", "written_at")).alias("version")).first()["version"]


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The current version of a state table; raises when there is none yet."""
    return spark.read.parquet(f"{root}/version={current_version(spark, root)}")


def _one_cell(df: DataFrame, column: str) -> Column:
    """A list as one text, items joined by "; "; any other value as it is."""
    if df.schema[column].dataType.typeName() != "array":
        return F.col(column)
    return F.array_join(F.transform(column, lambda x: x.cast("string")), "; ").alias(column)


def write_reports(datasets: dict[str, DataFrame], root: str, fmt: str = "parquet",
                  include_excluded: bool = True) -> str:
    """Write the report's datasets as one new version and make it the current one.

    All datasets go into the version's folder before the pointer moves, so a job that fails
    leaves the previous report whole and current. CSV cells hold lists as joined texts.
    """
    version = uuid.uuid4().hex
    wanted = {n: df for n, df in datasets.items() if include_excluded or n != "excluded"}
    if not wanted:
        raise ValueError("a report needs a dataset")
    for name, df in wanted.items():
        shown = df.select(*[_one_cell(df, c) for c in df.columns]) if fmt == "csv" else df
        shown.write.format(fmt).option("header", True).save(f"{root}/version={version}/{name}")
    move_pointer(next(iter(wanted.values())).sparkSession, root, version)
    return version


def report_path(spark: SparkSession, root: str, name: str) -> str:
    """Folder of a dataset of the current report."""
    return f"{root}/version={current_version(spark, root)}/{name}"
