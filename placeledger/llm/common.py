"""Small helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from placeledger.session import run_dir


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text): any other column of the input, whatever its name, stays out."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Names a row by its id and a hash of its text: rows without an id or with a repeated one
    can be told apart, and only equal rows are not. Rows with an id come first."""
    return F.struct(F.col(id_col).isNull().alias("nameless"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))


def drawn(df: DataFrame, by: str, key: str, rows: int) -> DataFrame:
    """At most `rows` rows of each value of `by`, those with the lowest hashes of `key`.

    A bound set by the value's count lets about twice as many through before they are
    ranked, so that a common value never brings all its rows to one task.
    """
    sizes = df.groupBy(by).agg(F.count("*").alias("_rows"))
    part = F.pmod(F.xxhash64(key), F.lit(1 << 40)) / float(1 << 40)
    # One row for each value of `by`: languages, or labels.
    few = df.join(F.broadcast(sizes), by).filter(part * F.col("_rows") < 2 * rows + 50)
    ranked = Window.partitionBy(by).orderBy(F.xxhash64(key), key)
    return few.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= rows).drop("_rows", "_rank")


def tasks(spark: SparkSession) -> int:
    """The number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def set_for(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session for what runs inside."""
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when it is written, not when the driver's
    memory happens to be collected."""
    with set_for(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder, read again: a lost executor repeats nothing before it."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hot_free_join(many: DataFrame, one: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """`many` to at most one row of `one` per key; both sides come straight from a shuffle,
    so that adaptive execution can split a partition that one key has filled."""
    spread = F.pmod(F.hash(on), F.lit(1024))
    both = many.withColumn("_spread", spread).join(one.withColumn("_spread", spread), [on, "_spread"], how)
    return both.drop("_spread")


def smallest_reachable(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and edges left-right: the smallest node that each can reach."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        # An edge may also tell the roots of its ends about each other.
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose sizes add up to `most` or little more."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        total += int(size)
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def text_slices(column: pa.Array, most: int = 1 << 20) -> Iterator[list[str | None]]:
    """The texts of a batch, a megabyte or little more at a time: the batch itself may hold
    thousands of long texts."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for lo, hi in slices(sizes, most):
        yield column.slice(lo, hi - lo).to_pylist()
