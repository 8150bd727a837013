"""Computing columns exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def stage(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with the columns added and pinned at this point of the plan.

    The optimiser copies an expression into every filter and projection above that
    mentions it; for long rule cascades the copies multiply. A one-row generator stops
    that, stays inside generated code, and costs no shuffle.
    """
    kept = [c for c in df.columns if c not in columns]
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(values)))


def spread(df: DataFrame) -> DataFrame:
    """The rows of `df` (stream or batch) dealt evenly to the session's tasks.

    A scan has no more tasks than its files have row groups, and a small file can hold very
    many rows: before a costly step on each row, such as parsing, its tasks are too few.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
