"""Queries on inputs and sizes that the driver tables of the other tests do not have."""

import duckdb
import pytest

from workload.catalog import ORACLES, QUERIES
from workload.verify import rows_of


@pytest.fixture
def against_sql(spark, tmp_path):
    """Rows of a query and of its SQL over the given tables."""
    def both(name, **tables):
        con = duckdb.connect()
        for t, df in tables.items():
            df.coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
        df = QUERIES[name](spark, str(tmp_path))
        result = con.execute(ORACLES[name])
        return rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of([d[0] for d in result.description], result.fetchall())

    return both


def _cut_pages(spark):
    pages = [
        "<h1>Price of the&&amp</h1><p>the ring is 120 &quot</p>", "<p>the ring 15&amp;&copy 2</p>", "<p>the ring 7 &amp;amp;&lt; & &#49;</p>",
        "<a title='&amp'>the king</a> is &quot;12&quot; &middot x", None]
    return spark.createDataFrame([(n, "https://h.example/p", html) for n, html in enumerate(pages)], "page_id bigint, url string, html string")


@pytest.mark.parametrize("name", ["visible_lines", "line_prices", "best_price_per_page"])
def test_cut_references_of_pages(spark, against_sql, name):
    got, wanted = against_sql(name, pages=_cut_pages(spark))
    assert got == wanted and got[0]


def test_sign_of_zero_in_coordinate_keys(spark, against_sql):
    rows = [(1, 0, -0.0), (2, 0, 0.0), (3, 0, -0.0001), (4, 1, -0.0), (5, 2, 12.5)]
    customer = spark.createDataFrame(rows, "c_custkey bigint, c_nationkey int, c_acctbal double")
    got, wanted = against_sql("coordinate_key_dupes", customer=customer)
    assert got == wanted and len(got[0]) == 4


def test_cells_share_rows_of_state(spark, tmp_path):
    """However many cells there are, Python is called once a bucket, and cells of a bucket keep apart."""
    from placeledger.streaming.cell_life import cell_changes, current_cells
    from placeledger.streaming.flows import append_available

    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "cell_id bigint, attempt int, event string, at timestamp"
    parts = [
        "SELECT id AS cell_id, 1 AS attempt, 'running' AS event, timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, id) AS at FROM range(60)",
        "SELECT id, 1, 'failed', timestamp'2024-01-01 02:00:00' FROM range(0, 60, 3)", "SELECT 999, 1, 'running', timestamp'2024-01-02'"]
    for part in parts:
        spark.sql(part).toDF("cell_id", "attempt", "event", "at").coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(schema).parquet(inbox)
        query = append_available(cell_changes(stream, 2, 30, "10 minutes", buckets=3), out, state)
        query.awaitTermination()
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 3
    changes = spark.read.parquet(out)
    got = {r["cell_id"]: (r["status"], r["attempts"], r["interrupted"]) for r in current_cells(changes).collect()}
    assert got == {999: ("in_progress", 1, False)} | {n: ("pending", 1, n % 3 > 0) for n in range(60)}
    assert changes.groupBy("cell_id", "change").count().filter("count > 1").isEmpty()


def test_pairs_of_point_and_region_are_not_shuffled(spark, tmp_path):
    from placeledger.operators.locate import regions_of_points

    square = lambda n: [{"points": [{"lon": x, "lat": y} for x, y in ((n, 0.0), (1.02, 0.0), (1.02, 1.0 + n), (n, 1.0))]}]
    boundaries = spark.createDataFrame(
        [(n, square(n / 100)) for n in range(30)], "region_id bigint, rings array<struct<points:array<struct<lon:double,lat:double>>>>")
    points = spark.range(500).selectExpr("id AS point", "id % 10 * 0.1 + 0.313 AS lon", "0.001 * id AS lat")
    found = regions_of_points(points, boundaries, "point")
    inside = points.join(boundaries, how="cross").filter("lon < 1.02 AND lon > region_id / 100")
    assert found.count() == inside.count() and found.distinct().count() == found.count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "Exchange hashpartitioning(point" not in plan


def test_one_tile_is_shared_by_tasks(spark):
    """All points in one place: their pairs are met in more than one task."""
    from pyspark.sql import functions as F

    from placeledger.operators.nearby import points_within

    centres = spark.createDataFrame([(n, 10.0, 20.0) for n in range(20)], "centre bigint, lat double, lon double")
    points = spark.createDataFrame([(n, 10.0, 20.0) for n in range(400)], "point bigint, lat double, lon double")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = points_within(centres, points, 1000.0, "centre", "point").withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert len(pairs) == 8000 == len({(r["centre"], r["point"]) for r in pairs})
    assert len({r["task"] for r in pairs}) > 1
