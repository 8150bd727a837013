"""Queries on pages whose structured blocks and texts decide the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeledger import schemas
from placeledger.operators.evidence import json_ld_evidence
from placeledger.plans.pricing import extract_prices
from workload.entities import as_of
from workload.registry import query
from workload.views import table

LEVELS = 10


def _blocks():
    """Three blocks for each page: a broken one, a node ten lists deep, and a graph inside
    lists whose nodes state their prices in every way there is."""
    script = lambda body: f'<script type="application/ld+json">{body}</script>'
    deep = '{"itemListElement":[[' * LEVELS + '{"name":"deep","price":#SIZE#}' + "]]}" * LEVELS
    graph = (
        '[[{"@graph":[{"name":"offer","offers":{"price":"#SIZE# USD"}},{"name":"zero","price":0,"hasOfferCatalog":'
        '{"itemListElement":[{"title":"low","offers":{"lowPrice":#ID#,"price":""}}]}},{"name":"listed","offers":[1],"price":true},'
        '{"name":"none","price":null},{"price":5}]}]]')
    return script('{"broken') + script(deep) + script(graph)


@query(f"""
    WITH p AS (SELECT page_id AS id, CAST(length(html) AS VARCHAR) AS size FROM pages)
    SELECT id AS page_id, v.block, v.pos, v.name,
      CASE v.name WHEN 'deep' THEN size WHEN 'offer' THEN size || ' USD' WHEN 'zero' THEN '0' WHEN 'low' THEN CAST(id AS VARCHAR) ELSE 'True' END AS price_text,
      CASE v.name WHEN 'deep' THEN CAST(size AS DOUBLE) WHEN 'zero' THEN 0.0 WHEN 'low' THEN CAST(id AS DOUBLE) END AS price_number, v.kind AS price_kind
    FROM p, (VALUES (1, {LEVELS}, 'deep', 'number'), (2, 1, 'offer', 'string'), (2, 2, 'zero', 'number'), (2, 4, 'low', 'number'),
      (2, 5, 'listed', 'boolean')) v(block, pos, name, kind)
""")
def json_ld_prices(spark, sf):
    blocks = F.replace(
        F.replace(F.lit(_blocks()), F.lit("#SIZE#"), F.length("html").cast("string")), F.lit("#ID#"), F.col("page_id").cast("string"))
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("salon_id"), F.lit(1).alias("page_no"), F.col("url").alias("source_url"), F.concat(blocks, "html").alias("html"))
    return json_ld_evidence(pages).select(
        F.col("salon_id").alias("page_id"), "place.block", "place.pos", F.col("service_name_raw").alias("name"),
        "price_text", "price_number", "price_kind")


LIST_WORDS = {
    "base": ["flag a"], "coating": ["status f"], "strong": ["flag n status o"], "negative": ["mode rail"],
    "men": ["flag a mode rail"], "package": ["mode truck"], "unrelated": ["mode ship"],
}


@query("""
    WITH l AS (SELECT l_orderkey AS id, l_returnflag AS f, l_linestatus AS st, floor(l_extendedprice) AS p, l_linenumber % 3 = 2 AS rng,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, l_linestatus, floor(l_extendedprice)) AS pos FROM lineitem),
    m AS (SELECT *, CASE WHEN (f = 'N' AND st = 'O') OR (f = 'A' AND st = 'F') THEN 'found' WHEN st = 'F' THEN 'ambiguous' END AS v FROM l),
    b AS (SELECT id, arg_min(v, pos + CASE v WHEN 'found' THEN 0 ELSE 1000 END) AS v, min(pos) FILTER (WHERE v = 'found') AS pos FROM m WHERE v IS NOT NULL GROUP BY id)
    SELECT o_orderkey AS salon_id, CASE WHEN o_orderkey % 9 = 4 THEN 'error' ELSE coalesce(b.v, 'not_found') END AS status,
      CASE WHEN o_orderkey % 9 <> 4 AND b.v = 'found' AND NOT m.rng THEN CAST(m.p AS BIGINT) * 100 END AS amount_minor,
      CASE WHEN o_orderkey % 9 <> 4 AND b.v = 'found' AND m.rng THEN CAST(m.p AS BIGINT) * 100 END AS range_min_minor,
      CASE WHEN o_orderkey % 9 <> 4 AND b.v = 'found' AND m.rng THEN CAST(m.p + 50 AS BIGINT) * 100 END AS range_max_minor
    FROM orders LEFT JOIN b ON b.id = o_orderkey LEFT JOIN m ON m.id = b.id AND m.pos = b.pos
""")
def prices_of_price_lists(spark, sf):
    """An order as a site whose one page lists the order's lines: the page's text alone
    decides, unless fetching it failed."""
    price = F.floor("l_extendedprice").cast("bigint")
    item = F.struct("l_linenumber", "l_returnflag", "l_linestatus", price.alias("price"))
    amount = lambda i: F.concat(i["price"].cast("string"), F.when(
        i["l_linenumber"] % 3 == 2, F.concat(F.lit("-"), (i["price"] + 50).cast("string"))).otherwise(""))
    shown = F.transform(F.array_sort(F.collect_list(item)), lambda i: F.concat(
        F.lit("<li><b>Flag "), i["l_returnflag"], F.lit("</b> status&nbsp;"), i["l_linestatus"], F.lit(": "), amount(i), F.lit("</li>\n")))
    lists = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_join(shown, "").alias("items"))
    orders = table(spark, sf, "orders").select("o_orderkey")
    failed = F.col("o_orderkey") % 9 == 4
    pages = orders.join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("salon_id"), F.lit(1).alias("page_no"), F.lit("u").alias("source_url"),
        F.concat(F.lit("<style>li{margin:9}</style><ul>"), F.coalesce("items", F.lit("")), F.lit("</ul>")).alias("html"),
        F.when(failed, "timeout").alias("fetch_error"))
    salons = orders.select(
        F.col("o_orderkey").alias("id"), F.lit("accepted").alias("filter_status"), F.lit("https://s.example.com").alias("website"))
    none = spark.createDataFrame([], schemas.DETAIL_PAYLOAD)
    return extract_prices(salons, none, pages, as_of(), LIST_WORDS).select(
        "salon_id", F.col("extraction_status").alias("status"), "amount_minor", "range_min_minor", "range_max_minor")
