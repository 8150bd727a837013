"""Findings of round three: what is computed once, dealt evenly, and kept small."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from placeledger.operators.numbering import number_rows
from placeledger.operators.stage import spread


def test_rows_are_computed_once_before_they_are_numbered(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf(LongType())
    def counted(x):
        seen.add(1)
        return x

    df = spark.range(500).repartition(4).select(counted("id").alias("k"))
    got = number_rows(df, "n", "k").select("k", "n").collect()
    assert sorted(tuple(r) for r in got) == [(i, i) for i in range(500)]
    assert seen.value == 500


def test_rows_of_one_partition_are_dealt_to_all_tasks(spark):
    df = spread(spark.range(1000).coalesce(1))
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(sizes) == 1000
