"""Every registered query against its SQL, and the plans of some of them."""

import os

import duckdb
import pytest

from workload import entities
from workload.catalog import ORACLES, QUERIES
from workload.verify import TABLES, rows_of

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    assert got == rows_of([d[0] for d in result.description], result.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", ["identity_match", "salons_in_radius", "accepted_export", "scan_tasks", "key_resolution"])
def test_no_cross_joins(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rank_limits_apply_before_the_shuffle(spark):
    plan = QUERIES["latest_payloads_per_salon"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_scan_reads_needed_columns_only(spark):
    plan = QUERIES["cell_status_counts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "c_name" not in plan and "c_acctbal" not in plan


def test_price_query_reads_every_page(spark, monkeypatch):
    """Each page's text reaches the price extraction under one salon of the result."""
    given = {}
    monkeypatch.setattr(entities, "extract_prices", lambda salons, details, pages, as_of: given.update(pages=pages) or salons.selectExpr(
        "id AS salon_id", "'' AS extraction_status", "0 AS amount_minor", "'' AS source_type"))
    result = entities.extracted_prices(spark, "/root/testdata/sf0.01")
    texts = given["pages"].filter("html LIKE '<p>Маникюр с покрытием 700 руб</p>_%'").select("salon_id", "page_no", "html").collect()
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert sorted(r["html"].partition("</p>")[2] for r in texts) == sorted(r["html"] for r in pages if r["html"])
    assert len({(r["salon_id"], r["page_no"]) for r in texts}) == len(texts)
    assert {r["salon_id"] for r in texts} <= {r["salon_id"] for r in result.collect()}
