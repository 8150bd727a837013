"""Listing-shaped views over the driver tables.

One SQL text per view, valid in both engines; `{table}` stands for a driver table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_regions": """
        SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name, r_regionkey + 1 AS scan_order,
               CASE r_regionkey % 3 WHEN 0 THEN 'in_progress' WHEN 1 THEN 'pending' ELSE 'completed' END AS status
        FROM {region}""",
    "v_cells": """
        SELECT c_custkey AS id, CAST(n_regionkey AS BIGINT) AS region_id, c_custkey + 1 AS cell_order,
               CASE WHEN n_regionkey = 2 AND c_custkey % 4 IN (0, 3) THEN 'completed'
                    ELSE CASE c_custkey % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'completed'
                         WHEN 2 THEN 'failed' ELSE 'in_progress' END END AS status,
               CAST(c_custkey % 5 AS INT) AS attempts,
               CAST(50 AS DOUBLE) + CAST(c_custkey % 997 AS DOUBLE) / 64 AS center_lat,
               CAST(20 AS DOUBLE) + CAST(c_custkey % 1009 AS DOUBLE) / 32 AS center_lon
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "v_grids": """
        SELECT CAST(r_regionkey AS BIGINT) AS region_id,
               CASE WHEN r_regionkey = 1 THEN 'failed' ELSE 'complete' END AS status,
               CASE WHEN r_regionkey = 3 THEN 1000 ELSE 1500 END AS cell_size_meters,
               COALESCE(n, 0) + CASE WHEN r_regionkey = 4 THEN 1 ELSE 0 END AS expected_cells,
               COALESCE(n, 0) AS persisted_cells, 'v1' AS generator_version
        FROM {region} LEFT JOIN (
            SELECT n_regionkey, COUNT(*) AS n FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
            GROUP BY n_regionkey) t ON n_regionkey = r_regionkey""",
    "v_salons": """
        SELECT c_custkey AS id, CAST(n_regionkey AS BIGINT) AS region_id, c_custkey % 25 AS grid_cell_id,
               CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE '2GIS' END AS external_source, '2gis' AS source,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END AS external_id,
               c_name AS name, lower(replace(c_name, '#', ' ')) AS normalized_name,
               'Street ' || CAST(c_nationkey AS STRING) AS address,
               'street ' || CAST(c_nationkey AS STRING) AS normalized_address, CAST(NULL AS STRING) AS city,
               CAST(50 AS DOUBLE) + CAST(c_custkey % 997 AS DOUBLE) / 64 AS latitude,
               CAST(20 AS DOUBLE) + CAST(c_custkey % 1009 AS DOUBLE) / 32 AS longitude,
               '7999' || CAST(1000000 + c_custkey % 50 AS STRING) AS phone,
               CASE WHEN c_custkey % 2 = 1 THEN NULL ELSE 'https://s' || CAST(c_custkey AS STRING) || '.example.com' END AS website,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'rejected' WHEN 'FURNITURE' THEN NULL ELSE 'accepted' END AS filter_status,
               CASE c_custkey % 5 WHEN 0 THEN 'not_checked' WHEN 1 THEN 'price_found' WHEN 2 THEN 'not_found'
                    WHEN 3 THEN 'ambiguous' ELSE 'error' END AS verification_status,
               CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'success' WHEN 2 THEN 'success' ELSE 'not_found' END AS details_status,
               CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST('2024-01-01 00:00:00' AS TIMESTAMP)
                    ELSE CAST('2024-03-01 12:00:00' AS TIMESTAMP) END AS details_enriched_at,
               CASE c_custkey % 3 WHEN 0 THEN 'nail_specialist' WHEN 1 THEN 'mixed_beauty_salon' ELSE NULL END AS business_profile,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'no_signal' ELSE NULL END AS rejection_reason,
               CASE c_custkey % 3 WHEN 0 THEN 'v1' WHEN 1 THEN 'v2' ELSE NULL END AS classifier_version,
               '2023-05-0' || CAST(1 + c_custkey % 9 AS STRING) || 'T10:00:00+03:00' AS first_seen_text,
               '2024-02-0' || CAST(1 + c_custkey % 9 AS STRING) || ' 08:30:00' AS last_seen_text,
               c_acctbal AS acctbal, c_mktsegment AS segment
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "v_disc": """
        SELECT o_orderkey AS id, o_custkey AS cust,
               CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderkey % 10 END AS salon_id,
               o_orderkey AS raw_result_id, o_custkey % 5 AS region_id, o_orderkey % 25 AS grid_cell_id,
               o_orderpriority AS query, '2GIS' AS external_source,
               CASE WHEN o_custkey % 13 = 0 THEN ' ' ELSE CAST(o_custkey AS STRING) END AS external_id,
               CASE o_orderstatus WHEN 'O' THEN 'accepted' ELSE 'rejected' END AS filter_status,
               CASE o_orderstatus WHEN 'O' THEN NULL WHEN 'P' THEN 'no_signal' ELSE 'training_only' END AS rejection_reason,
               CASE o_orderstatus WHEN 'O' THEN 'nail_specialist' ELSE 'unknown' END AS business_profile,
               o_totalprice AS price, o_orderdate AS fetched_at
        FROM {orders}""",
    "v_contacts": """
        SELECT event_id AS id, user_id AS salon_id,
               CASE event_type WHEN 'signup' THEN 'phone' WHEN 'view' THEN 'website' WHEN 'click' THEN 'social'
                    WHEN 'purchase' THEN 'email' ELSE 'phone' END AS contact_type,
               props AS normalized_value, '2GIS' AS source, ts, event_id % 4 <> 0 AS is_active
        FROM {events}""",
    "v_prices": """
        SELECT ((l_orderkey * 1000000 + l_partkey) * 100000 + l_suppkey) * 10 + l_linenumber AS id, l_suppkey AS salon_id,
               CASE WHEN l_returnflag = 'A' THEN 'basic_manicure_with_coating' ELSE l_returnflag END AS service_key,
               CASE l_linenumber % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'from' WHEN 2 THEN 'range' ELSE 'ambiguous' END AS price_type,
               CASE WHEN l_linenumber % 4 IN (0, 1) THEN CAST(floor(l_extendedprice) AS BIGINT) * 10 + l_linenumber END AS amount_minor,
               CASE WHEN l_linenumber % 4 = 2 THEN CAST(floor(l_extendedprice) AS BIGINT) END AS range_min_minor,
               CASE WHEN l_linenumber % 4 = 2 THEN CAST(floor(l_extendedprice) AS BIGINT) * 2 END AS range_max_minor,
               'RUB' AS currency, 'part ' || CAST(l_partkey AS STRING) AS service_name_raw,
               l_linestatus = 'O' AS is_active, 'website_text' AS source_type,
               'https://p.example.com/' || CAST(l_partkey AS STRING) AS source_url,
               'line ' || CAST(l_partkey % 50 AS STRING) AS evidence_text, l_orderkey, l_linenumber, l_shipdate
        FROM {lineitem}""",
}


def _tables(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, or one of the views above."""
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    text = VIEWS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in _tables(text)})


def with_views(sql: str) -> str:
    """Prefix a DuckDB query with the views it mentions."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    plain = {v: re.sub(r"\{(\w+)\}", r"\1", VIEWS[v]) for v in used}
    ctes = ",\n".join(f"{v} AS ({text})" for v, text in plain.items())
    if not ctes:
        return sql
    body = sql.strip()
    if re.match(r"(?i)with\s+recursive\b", body):
        return f"WITH RECURSIVE {ctes},\n{body[len('WITH RECURSIVE'):]}"
    if body.lower().startswith("with"):
        return f"WITH {ctes},\n{body[4:]}"
    return f"WITH {ctes}\n{body}"
