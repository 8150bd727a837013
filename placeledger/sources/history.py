"""Append-only history in folders by its partition columns.

A batch writes its rows below `<column>=<value>/.../folder=<name>`; a catalogue of the folders
that count is stored beside them as numbered snapshots. A reader joins the folders with the
catalogue on the partition columns, so that dynamic partition pruning opens the files of
live folders only, and of the wanted ones where the catalogue is filtered. The catalogue has
a row for each folder, not for each row of data. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from placeledger.session import list_names
from placeledger.sources.sinks import read_snapshot, versions, write_snapshot

FOLDER = "folder"


def append_history(df: DataFrame, root: str, by: list[str], batch: str) -> bool:
    """Add a batch's rows; False when a batch of this name is in already.

    A batch whose job died half way left folders that no catalogue names; its next run writes
    new ones. NULL is a partition of its own; an empty batch adds no folder.
    """
    spark, live = df.sparkSession, None
    if _exists(spark, root):
        if versions(spark, f"{root}/_live").filter(F.col("version") == batch).limit(1).count():
            return False
        live = _live(spark, root)
    new = _write(df, root, by, f"{batch}-{uuid.uuid4().hex}")
    write_snapshot((new if live is None else live.unionByName(new)).coalesce(1), f"{root}/_live", batch)
    return True


def read_history(spark: SparkSession, root: str, where: Column | None = None) -> DataFrame:
    """The rows of live folders, of those whose partition columns fulfil `where` if given."""
    live = _live(spark, root)
    return _rows_of(spark, root, live, live if where is None else live.filter(where))


def compact_history(spark: SparkSession, root: str, most_folders: int = 1) -> int:
    """Rewrite the partitions that have more than `most_folders` live folders as one folder each
    and give their number; the others keep their files.

    Rows are neither lost nor doubled for a reader at any moment: the new catalogue is one
    snapshot, and old folders stay where they are for those who still read them.
    """
    live = _live(spark, root)
    by = _by(live)
    crowded = live.groupBy(*by).agg(F.count("*").alias("n")).filter(F.col("n") > most_folders)
    due = crowded.count()
    if due:
        name = f"compact-{uuid.uuid4().hex}"
        new = _write(_rows_of(spark, root, live, _matching(live, crowded, by, "left_semi")), root, by, name)
        kept = _matching(live, crowded, by, "left_anti")
        write_snapshot(kept.unionByName(new).coalesce(1), f"{root}/_live", name)
    return due


def folder_counts(spark: SparkSession, root: str) -> DataFrame:
    """Live folders and their rows for each partition."""
    live = _live(spark, root)
    return live.groupBy(*_by(live)).agg(F.count("*").alias("folders"), F.sum("n_rows").alias("n_rows"))


def _exists(spark: SparkSession, root: str) -> bool:
    return bool(list_names(spark, f"{root}/_live/_pointers"))


def _live(spark: SparkSession, root: str) -> DataFrame:
    """Partition columns, folder and number of rows of every live folder."""
    return read_snapshot(spark, f"{root}/_live")


def _by(live: DataFrame) -> list[str]:
    return [c for c in live.columns if c not in (FOLDER, "n_rows")]


def _matching(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Rows of `left` by whether `right` has their values, NULL like any other. Pruning looks at
    plain equations only, hence those of the texts beside the null-safe ones."""
    same = F.lit(True)
    for c in columns:
        a, b = F.col(f"l.{c}"), F.col(f"r.{c}")
        same = same & a.eqNullSafe(b) & (F.coalesce(a.cast("string"), F.lit("")) == F.coalesce(b.cast("string"), F.lit("")))
    return left.alias("l").join(right.alias("r"), same, how)


def _rows_of(spark: SparkSession, root: str, live: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the wanted folders. A folder has rows; saying so marks the catalogue as a
    selection, for which Spark considers pruning. It is broadcast if its size allows."""
    stored = spark.read.parquet(f"{root}/rows").schema
    places = [live.schema[c] for c in (*_by(live), FOLDER)]
    names = {f.name for f in places}
    schema = StructType([*[f for f in stored if f.name not in names], *places])
    rows = spark.read.schema(schema).parquet(f"{root}/rows")
    return _matching(rows, wanted.filter("n_rows > 0"), [FOLDER, *_by(live)], "left_semi").drop(FOLDER)


def _write(df: DataFrame, root: str, by: list[str], name: str) -> DataFrame:
    """Write rows as folders of this name and give their catalogue. Rows are rebalanced by
    partition: one file for a small one, several tasks for a large one."""
    named = df.withColumn(FOLDER, F.lit(name))
    named.hint("rebalance", *by).write.mode("append").partitionBy(*by, FOLDER).parquet(f"{root}/rows")
    schema = named.select(*by, FOLDER).schema
    written = df.sparkSession.read.schema(schema).parquet(f"{root}/rows").filter(F.col(FOLDER) == name)
    return written.groupBy(*by, FOLDER).agg(F.count("*").alias("n_rows"))
