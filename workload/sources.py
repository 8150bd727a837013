"""Readers, sinks, dimensions, lenient JSON and run counters."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from placeledger.fixed_values import REGIONS
from placeledger.functions import jsons as J, prices, text
from placeledger.functions.geo import cell_radius_m
from placeledger.operators.cells import attempt_errors
from placeledger.operators.backfill import backfill_counters
from placeledger.operators.merge import canonical_candidates
from placeledger.operators.numbering import number_rows
from placeledger.operators.parse_details import enrichment_counters, parse_details
from placeledger.operators.parse_search import category_names, parse_search
from placeledger.operators.reclassify import classifier_input, reclassify, reclassify_counters
from placeledger.operators.resolve import administrative_relations
from placeledger.plans import reports as R
from placeledger.plans.pricing import pricing_counters
from placeledger.session import run_dir
from placeledger.sources import dimensions, readers, sinks
from workload import entities as E
from workload.registry import ORACLES, query
from workload.reports import LISTS, _contacts, _salons
from workload.views import table, view


def counted(name: str, counts: str) -> str:
    """SQL that counts over another query's rows."""
    return f"SELECT {counts} FROM ({ORACLES[name]})"


@query("""
    SELECT o_orderkey AS cell, CASE o_orderkey % 7 WHEN 0 THEN 'empty' WHEN 1 THEN 'error' WHEN 2 THEN 'error' ELSE 'ok' END AS status,
      CAST(CASE WHEN o_orderkey % 7 > 2 THEN 2 ELSE 0 END AS BIGINT) AS n_items FROM orders
""")
def landed_search(spark, sf):
    """Search responses landed as files and read back by their reader."""
    path = run_dir(spark, "landed-search")
    E._search_bodies(spark, sf).write.json(path)
    _, pages = parse_search(readers.search_responses(spark, path))
    return pages.select(F.col("grid_cell_id").alias("cell"), "status", "n_items")


@query("""
    SELECT c_custkey AS id, CASE c_custkey % 10 WHEN 0 THEN 'not_found' WHEN 1 THEN 'unauthorized'
      WHEN 2 THEN 'parser_error' WHEN 3 THEN 'rate_limited' WHEN 4 THEN 'transient_error' ELSE 'success' END AS status FROM customer
""")
def landed_details(spark, sf):
    path = run_dir(spark, "landed-details")
    E._details_bodies(spark, sf).write.json(path)
    return parse_details(readers.details_responses(spark, path))[2].select("id", "status")


@query("""
    WITH s AS (SELECT s_suppkey AS k, CAST(s_suppkey % 90 AS DOUBLE) AS x FROM supplier),
    r AS (SELECT k, x, 0 AS polygon, 0 AS ring, 5 AS n_points FROM s UNION ALL SELECT k, x + 0.25, 0, 1, 4 FROM s
      UNION ALL SELECT k, x + 2, 1, 0, 5 FROM s WHERE k % 2 = 0)
    SELECT k AS region_id, row_number() OVER (PARTITION BY k ORDER BY polygon, ring) AS place, ring > 0 AS is_hole, n_points, x AS first_lon FROM r
""")
def boundary_rings(spark, sf):
    """GeoJSON documents, one a line: a polygon with a hole, half of them with an island."""
    x = F.col("s_suppkey") % 90

    def ring(offset, corners):
        return F.array(*[F.array((x + offset + a).cast("double"), F.lit(float(b))) for a, b in corners])

    square = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    main = F.array(ring(0, square), ring(0.25, [(0, 0.25), (0.25, 0.25), (0.25, 0.5), (0, 0.25)]))
    one = F.struct(F.lit("Polygon").alias("type"), main.alias("coordinates"))
    many = F.struct(F.lit("MultiPolygon").alias("type"), F.array(main, F.array(ring(2, square))).alias("coordinates"))
    geometry = F.when(F.col("s_suppkey") % 2 == 0, F.to_json(many)).otherwise(F.to_json(one))
    path = run_dir(spark, "boundaries")
    table(spark, sf, "supplier").select(F.concat(
        F.lit('{"region_id":'), F.col("s_suppkey").cast("string"), F.lit(',"geometry":'), geometry, F.lit("}"))).write.text(path)
    rings = readers.boundaries(spark, path, multi_line=False).select("region_id", F.inline("rings"))
    place = F.row_number().over(Window.partitionBy("region_id").orderBy("ring_id"))
    return rings.select(
        "region_id", place.cast("bigint").alias("place"), "is_hole", F.size("points").alias("n_points"), F.col("points")[0]["lon"].alias("first_lon"))


@query(f"""
    WITH {LISTS},
    shown AS (SELECT id, phones, price, row_number() OVER (ORDER BY scan_order, name, id) AS place FROM acc)
    SELECT 'csv' AS fmt, id, place, replace(phones, '|', '; ') AS phones, price FROM shown
    UNION ALL SELECT 'parquet', id, place, replace(phones, '|', '; '), price FROM shown
""")
def export_written(spark, sf):
    """The report written as both formats and read back, with the place of each row."""
    args = (_salons(spark, sf), view(spark, sf, "v_regions"), _contacts(spark, sf), view(spark, sf, "v_prices"))
    datasets = R.export_datasets(*args, view(spark, sf, "v_grids"), "2024-06-01", "store", "v2")
    # Rows keep their order in the file; its number is the place.
    def placed(df):
        return number_rows(df.withColumn("_order", F.monotonically_increasing_id()), "place", "_order", start=1).drop("_order")

    numbered = {n: placed(df) if n == "accepted" else df for n, df in datasets.items()}
    parts = []
    for fmt in ("csv", "parquet"):
        root = run_dir(spark, f"report-{fmt}")
        sinks.write_reports(numbered, root, fmt)
        rows = spark.read.format(fmt).option("header", True).load(sinks.report_path(spark, root, "accepted"))
        phones = F.coalesce("phones", F.lit("")) if fmt == "csv" else F.array_join("phones", "; ")
        parts.append(rows.select(
            F.lit(fmt).alias("fmt"), F.col("id").cast("bigint").alias("id"), F.col("place").cast("bigint").alias("place"), phones.alias("phones"),
            F.col("price").cast("string").alias("price")))
    return parts[0].unionByName(parts[1])


@query("""
    SELECT s.id, r.name AS region FROM v_salons s JOIN v_regions r ON r.id = s.region_id WHERE filter_status = 'accepted' AND region_id = 2
    UNION ALL SELECT s.id, r.name FROM v_salons s JOIN v_regions r ON r.id = s.region_id WHERE filter_status = 'rejected' AND region_id = 3
""")
def reports_of_one_region(spark, sf):
    salons, regions = _salons(spark, sf), view(spark, sf, "v_regions")
    accepted = R.accepted_report(salons, regions, _contacts(spark, sf), view(spark, sf, "v_prices"), region_id=2)
    return accepted.select("id", "region").unionByName(R.excluded_report(salons, regions, region_id=3).select("id", "region"))


REGION_ROWS = ", ".join("({}, '{}', {})".format(n, name, f"'{iso}'" if iso else "NULL") for n, name, iso in REGIONS)


@query(f"""
    SELECT c_custkey AS id, name, iso3166_2 FROM customer
    JOIN (VALUES {REGION_ROWS}) r(scan_order, name, iso3166_2) ON r.scan_order = c_custkey % 89 + 1
""")
def region_of_customer(spark, sf):
    listed = dimensions.regions(spark)
    return table(spark, sf, "customer").withColumn("scan_order", (F.col("c_custkey") % 89 + 1).cast("int")).join(
        listed, "scan_order").select(F.col("c_custkey").alias("id"), "name", "iso3166_2")


@query("""
    SELECT event_id AS id, 'a|' || (event_id + 1) || '|' || event_type || '|{"k":1}' AS items, '{"n":"' || (event_id + 1) || '","t":"' || event_type || '"}' AS pairs,
      '15000000.5|0.0001|12345678901234567890123|' || (event_id + 1) AS numbers
    FROM events
""")
def json_lists_and_maps(spark, sf):
    i, kind = (F.col("event_id") + 1).cast("string"), F.col("event_type")
    events = table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit('["a",'), i, F.lit(',null,"",0,"'), kind, F.lit('",{"k":1},[]]')).alias("list"),
        F.concat(F.lit('{"t":"'), kind, F.lit('","n":'), i, F.lit("}")).alias("map"),
        F.concat(F.lit("[15000000.5,0.0001,12345678901234567890123,"), i, F.lit("]")).alias("plain"))
    numbers = F.transform(J.elements(J.lenient("plain")), J.number_text)
    return events.select(
        "id", F.array_join(J.string_list("list"), "|").alias("items"), J.sorted_json(J.string_map("map")).alias("pairs"),
        F.array_join(numbers, "|").alias("numbers"))


@query("""
    SELECT o_orderkey AS id, o_orderpriority || '|b' || o_custkey || '|C|D' AS names FROM orders
""")
def wide_categories(spark, sf):
    body = F.concat(
        F.lit('{"rubrics":[{"name":"'), "o_orderpriority", F.lit('"},{"name":"","alias":"b'), F.col("o_custkey").cast("string"),
        F.lit('"},{"x":1}],"categories":["C","",null,{"name":"","alias":"D"}]}'))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.array_join(category_names(J.lenient(body)), "|").alias("names"))


@query("""
    SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'RUB' END AS currency,
      CAST(CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE p_size * 100 END AS BIGINT) AS amount_minor FROM part
""")
def currencies(spark, sf):
    words = {"$": "USD", "eur": "EUR"}
    k, size = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    arabic = F.translate(size, "0123456789", "٠١٢٣٤٥٦٧٨٩")
    written = F.when(k == 0, F.concat(F.lit("$"), size)).when(k == 1, F.concat(size, F.lit(" EUR"))).when(k == 2, arabic).otherwise("none")
    amount = F.when(k == 2, arabic).when(k == 3, "none").otherwise(size)
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), prices.detect_currency(written, words).alias("currency"), prices.amount_to_minor(amount).alias("amount_minor"))


@query("""
    SELECT id, CASE WHEN id % 4 = 0 THEN 'Paid ' || id WHEN id % 4 = 3 THEN '' ELSE name END AS name, CASE id % 4 WHEN 0 THEN 'R' WHEN 1 THEN segment ELSE '' END AS categories,
      id % 4 < 2 AS reliable, CASE WHEN id % 4 >= 2 THEN 'missing_name_or_categories' END AS issue FROM v_salons
""")
def classifier_inputs(spark, sf):
    """Payload first, stored row second, and whether the input is enough to decide on."""
    k = F.col("id") % 4
    payload = F.concat(F.lit('{"name":"Paid '), F.col("id").cast("string"), F.lit('","rubrics":[{"name":"R"}]}'))
    salons = view(spark, sf, "v_salons").withColumns({
        "raw_payload": F.when(k == 0, payload).when(k == 1, "{}").when(k == 2, "not json"),
        "categories": F.when(k == 1, F.array("segment")), "description": F.lit(None).cast("string"),
        "name": F.when(k == 3, F.lit(None).cast("string")).otherwise(F.col("name"))})
    return classifier_input(salons).select("id", "name", F.array_join("categories", "|").alias("categories"), "reliable", "issue")


@query("""
    SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'O' AND o_custkey % 3 = 0
""")
def administrative_boundaries(spark, sf):
    kind = F.when(F.col("o_orderstatus") == "O", "relation").when(F.col("o_orderstatus") == "F", "way").otherwise(None)
    tag = F.when(F.col("o_custkey") % 3 == 0, "administrative").when(F.col("o_custkey") % 3 == 1, "maritime")
    elements = table(spark, sf, "orders").select(kind.alias("type"), F.col("o_orderkey").alias("id"), F.create_map(F.lit("boundary"), tag).alias("tags"))
    return administrative_relations(elements).select("id")


@query("""
    SELECT id FROM v_disc WHERE filter_status = 'accepted' OR (external_id IS NOT NULL AND id % 3 <> 0 AND external_id <> '')
""")
def candidates_for_records(spark, sf):
    external = F.when(F.col("id") % 3 == 0, F.when(F.col("id") % 2 == 0, "")).otherwise(F.col("external_id"))
    rows = view(spark, sf, "v_disc").withColumns({"accepted": F.col("filter_status") == "accepted", "external_id": external})
    return canonical_candidates(rows).select("id")


@query("""
    SELECT c_custkey AS id, c_mktsegment || '|' || c_custkey AS seen, CAST(1061 AS INT) AS radius_m FROM customer
""")
def ordered_values(spark, sf):
    i = F.col("c_custkey").cast("string")
    values = F.array(F.concat(F.lit(" "), "c_mktsegment"), F.lit(""), i, F.col("c_mktsegment"), F.lit(None), F.concat(i, F.lit(" ")))
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.array_join(text.ordered_unique(values), "|").alias("seen"), F.lit(cell_radius_m(1500)).alias("radius_m"))


@query(f"""
    WITH {E.RESULTS}
    SELECT CAST(count(*) AS BIGINT) AS processed, CAST(count(*) FILTER (WHERE st = 'found') AS BIGINT) AS found,
      CAST(count(*) FILTER (WHERE st = 'ambiguous') AS BIGINT) AS ambiguous, CAST(0 AS BIGINT) AS errors,
      CAST(count(*) FILTER (WHERE st = 'not_found') AS BIGINT) AS not_found FROM res
""")
def pricing_run_counters(spark, sf):
    return pricing_counters(E._price_results(spark, sf))


@query(counted("reclassify_diff", """
    CAST(count(*) AS BIGINT) AS processed, CAST(count(*) FILTER (WHERE changed) AS BIGINT) AS changed,
    CAST(count(*) FILTER (WHERE new_status = 'accepted') AS BIGINT) AS accepted,
    CAST(count(*) FILTER (WHERE new_status = 'rejected') AS BIGINT) AS rejected, CAST(0 AS BIGINT) AS unreliable"""))
def reclassify_run_counters(spark, sf):
    salons = view(spark, sf, "v_salons").withColumns({
        "raw_payload": F.lit("{}"), "categories": F.array("segment"), "description": F.lit(None).cast("string")})
    return reclassify_counters(reclassify(salons, "v2", E.RULES))


@query(counted("contact_state", """
    (SELECT CAST(count(*) AS BIGINT) FROM customer) AS processed,
    (SELECT CAST(count(*) AS BIGINT) FROM customer WHERE c_custkey % 10 > 4) AS succeeded,
    (SELECT CAST(count(*) AS BIGINT) FROM customer WHERE c_custkey % 10 = 0) AS not_found,
    (SELECT CAST(count(*) AS BIGINT) FROM customer WHERE c_custkey % 10 BETWEEN 1 AND 4) AS failed,
    CAST(count(*) FILTER (WHERE change = 'created') AS BIGINT) AS contacts_created,
    CAST(count(*) FILTER (WHERE change = 'updated') AS BIGINT) AS contacts_updated,
    CAST(count(*) FILTER (WHERE change = 'deactivated') AS BIGINT) AS contacts_deactivated"""))
def enrichment_run_counters(spark, sf):
    return enrichment_counters(parse_details(E._details_bodies(spark, sf))[2], E._contact_state(spark, sf))


@query("""
    SELECT o_custkey % 100 AS cell, CAST(max(CASE WHEN o_orderkey % 7 IN (1, 2) THEN 1 ELSE 0 END) AS BIGINT) AS errors FROM orders GROUP BY 1
""")
def scan_errors(spark, sf):
    bodies = E._search_bodies(spark, sf).join(
        table(spark, sf, "orders").select(F.col("o_orderkey").alias("grid_cell_id"), (F.col("o_custkey") % 100).alias("cell")), "grid_cell_id")
    _, pages = parse_search(bodies.drop("grid_cell_id").withColumnRenamed("cell", "grid_cell_id"))
    return attempt_errors(pages).withColumnRenamed("grid_cell_id", "cell")


@query(counted("backfill_actions", """
    CAST(count(*) AS BIGINT) AS processed, CAST(count(*) FILTER (WHERE action = 'create') AS BIGINT) AS created,
    CAST(count(*) FILTER (WHERE action = 'update') AS BIGINT) AS updated, CAST(count(*) FILTER (WHERE action = 'unchanged') AS BIGINT) AS unchanged,
    CAST(0 AS BIGINT) AS skipped, CAST(count(*) FILTER (WHERE conflicting_decisions) AS BIGINT) AS conflicts"""))
def backfill_run_counters(spark, sf):
    return backfill_counters(E.backfill_actions(spark, sf))
