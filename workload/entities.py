"""Payload, identity, merge and current-state queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from placeledger.operators.backfill import backfill_plan, conflict_report, link_discoveries
from placeledger.operators.contact_state import contact_change_counts, merge_contacts
from placeledger.operators.identity import match_existing, resolve_batch
from placeledger.operators.merge import MergePolicy, merge_entities
from placeledger.operators.numbering import number_rows
from placeledger.operators.parse_details import parse_details
from placeledger.operators.parse_search import parse_search, scan_coverage
from placeledger.operators.price_state import merge_prices, summarize_prices
from placeledger.operators.reclassify import reclassify
from placeledger.operators.salon_state import apply_classification, apply_details
from placeledger.operators.stage import spread
from placeledger.plans.pricing import extract_prices, latest_payloads
from placeledger.sources.dimensions import region_keys, sync_regions
from placeledger.sources.evolve import union_evolved
from placeledger.operators.resolve import resolve_keys
from workload.registry import query
from workload.views import table, view

E = F.expr


def as_of():
    return F.lit(datetime(2024, 6, 1)).cast("timestamp_ntz")


def _search_bodies(spark, sf):
    """One response per order: an error, an empty page, or the customer as an item."""
    i, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    item = F.struct(
        c.alias("id"), F.concat(F.lit("Org "), c).alias("name"),
        F.when(i % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("Road "), c)).alias("address"),
        F.col("o_orderpriority").alias("address_name"),
        F.struct((F.col("o_totalprice") / 1000).alias("lat"), F.lit(20.5).alias("lon")).alias("point"),
        F.array(
            F.struct(F.lit("Cat A").alias("name")), F.struct(F.lit("").alias("name")),
            F.struct(F.col("o_orderstatus").alias("name")),
        ).alias("rubrics"),
        F.array(F.struct(F.array(
            F.struct(F.lit("phone").alias("type"), F.concat(F.lit("+7 "), c).alias("value")),
            F.struct(F.lit("site").alias("type"), F.concat(F.lit("s"), c, F.lit(".example.com")).alias("value")),
            F.struct(F.lit("vk").alias("type"), F.concat(F.lit("vk.com/"), c).alias("value")),
        ).alias("contacts"))).alias("contact_groups"),
    )
    body = (
        F.when(i % 7 == 0, F.lit('{"meta":{"code":404}}'))
        .when(i % 7 == 1, F.lit('{"meta":{"code":429}}'))
        .when(i % 7 == 2, F.lit("not json"))
        .otherwise(F.to_json(F.struct(
            F.struct(F.lit(200).alias("code")).alias("meta"),
            F.struct(F.array(item, item).alias("items"), (i % 50).alias("total")).alias("result"))))
    )
    return table(spark, sf, "orders").select(
        i.alias("grid_cell_id"), (F.col("o_custkey") % 5).alias("region_id"), F.col("o_orderpriority").alias("query"),
        (i % 3 + 1).cast("int").alias("page"), F.lit("u").alias("source_url"),
        F.lit(None).cast("timestamp_ntz").alias("fetched_at"), body.alias("body"))


@query("""
    SELECT o_orderkey AS cell, CAST(p AS INT) AS item_pos, CAST(o_custkey AS VARCHAR) AS external_id,
           'Org ' || o_custkey AS name, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE 'Road ' || o_custkey END AS address,
           round(o_totalprice / 1000, 6) AS latitude, 'Cat A,' || o_orderstatus AS categories, '+7 ' || o_custkey AS phone,
           's' || o_custkey || '.example.com' AS website, 'vk.com/' || o_custkey AS social
    FROM orders, (SELECT unnest([0, 1]) AS p) WHERE o_orderkey % 7 > 2
""")
def search_items_parse(spark, sf):
    items, _ = parse_search(_search_bodies(spark, sf))
    return items.select(
        F.col("discovered_grid_cell_id").alias("cell"), "item_pos", "external_id", "name", "address",
        F.round("latitude", 6).alias("latitude"), F.array_join("categories", ",").alias("categories"), "phone", "website",
        F.array_join("social_links", ",").alias("social"))


@query("""
    SELECT o_orderkey AS cell, CASE o_orderkey % 7 WHEN 0 THEN 'empty' WHEN 1 THEN 'error' WHEN 2 THEN 'error' ELSE 'ok' END AS status,
           CAST(CASE WHEN o_orderkey % 7 > 2 THEN 2 ELSE 0 END AS BIGINT) AS n_items,
           o_orderkey % 7 > 2 AND (o_orderkey % 3 + 1) * 10 < o_orderkey % 50 AS has_next_page
    FROM orders
""")
def page_completeness(spark, sf):
    _, pages = parse_search(_search_bodies(spark, sf))
    return pages.select(F.col("grid_cell_id").alias("cell"), "status", "n_items", "has_next_page")


@query("""
    SELECT o_custkey % 100 AS cell, o_orderpriority AS query, CAST(max(page) AS INT) AS pages_read, CAST(sum(n) AS BIGINT) AS items_seen,
           bool_or(more) AS has_more, bool_or(more) AND max(page) >= 3 AS cut_by_limit FROM (
      SELECT *, o_orderkey % 3 + 1 AS page, 10 AS n, o_orderkey % 3 = 2 AS more FROM orders) GROUP BY 1, 2
""")
def scan_coverage_by_cell(spark, sf):
    pages = table(spark, sf, "orders").select(
        (F.col("o_custkey") % 100).alias("grid_cell_id"), F.col("o_orderpriority").alias("query"),
        (F.col("o_orderkey") % 3 + 1).cast("int").alias("page"), F.lit(10).cast("bigint").alias("n_items"),
        (F.col("o_orderkey") % 3 == 2).alias("has_next_page"))
    # The last page decides; here page 3 always has more and the others never.
    return scan_coverage(pages, 3).select(
        F.col("grid_cell_id").alias("cell"), "query", "pages_read", "items_seen", "has_more", "cut_by_limit")


def _details_bodies(spark, sf):
    i, c = F.col("c_custkey"), F.col("c_custkey").cast("string")
    item = F.struct(
        F.concat(F.lit("b"), c).alias("id"), F.col("c_name").alias("name"),
        F.when(i % 2 == 0, F.concat(F.lit("Full "), c)).alias("full_address_name"),
        F.struct(F.col("c_mktsegment").alias("name")).alias("address"),
        F.struct(F.struct(F.concat(F.lit("0"), (i % 10).cast("string"), F.lit(":00")).alias("from")).alias("Mon")).alias("schedule"),
        F.struct(c.alias("id")).alias("org"), F.when(i % 3 == 0, F.lit("2024-01-01")).alias("last_update"),
        F.array(F.struct(F.array(
            F.struct(F.lit("phone").alias("type"), F.concat(F.lit("8 900 "), F.lpad(c, 7, "0")).alias("value")),
            F.struct(F.lit("phone").alias("type"), F.concat(F.lit("+7 (900) "), F.lpad(c, 7, "0")).alias("value")),
            F.struct(F.lit("email").alias("type"), F.when(i % 4 == 0, "broken").otherwise(F.concat(F.lit("U"), c, F.lit("@x.ru"))).alias("value")),
            F.struct(F.lit("website").alias("type"), F.concat(F.lit("VK.com/u"), c, F.lit("/")).alias("value")),
        ).alias("contacts"))).alias("contact_groups"),
    )
    ok = F.to_json(F.struct(F.struct(F.lit(200).alias("code")).alias("meta"), F.struct(F.array(item).alias("items")).alias("result")))
    body = (
        F.when(i % 10 == 0, F.lit('{"meta":{"code":404}}')).when(i % 10 == 1, F.lit('{"meta":{"code":403}}'))
        .when(i % 10 == 2, F.lit('{"meta":{"code":200},"result":{"items":[]}}')).otherwise(ok)
    )
    http = F.when(i % 10 == 3, 429).when(i % 10 == 4, 503).otherwise(200).cast("int")
    return spread(table(spark, sf, "customer")).select(
        i.alias("id"), i.alias("salon_id"), c.alias("external_id"), http.alias("http_status"), F.lit("u").alias("source_url"),
        body.alias("body"))


@query("""
    SELECT status, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE c_custkey % 10 WHEN 0 THEN 'not_found' WHEN 1 THEN 'unauthorized'
      WHEN 2 THEN 'parser_error' WHEN 3 THEN 'rate_limited' WHEN 4 THEN 'transient_error' ELSE 'success' END AS status FROM customer) GROUP BY 1
""")
def details_status(spark, sf):
    return parse_details(_details_bodies(spark, sf))[2].groupBy("status").agg(F.count("*").alias("n"))


@query("""
    SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'Full ' || c_custkey ELSE c_mktsegment END AS full_address,
           CAST(c_custkey AS VARCHAR) AS organization_id, 'b' || c_custkey AS branch_id,
           CASE WHEN c_custkey % 3 = 0 THEN '2024-01-01' END AS provider_updated_at,
           '{"Mon":{"from":"0' || c_custkey % 10 || ':00"}}' AS working_hours, '{"id":"' || c_custkey || '"}' AS branch_info
    FROM customer WHERE c_custkey % 10 > 4
""")
def details_fields(spark, sf):
    return parse_details(_details_bodies(spark, sf))[0].select(
        "id", "name", "full_address", "organization_id", "branch_id", "provider_updated_at", "working_hours", "branch_info")


@query("""
    SELECT c_custkey AS salon_id, t AS contact_type, v AS normalized_value FROM (
      SELECT c_custkey, 'phone' AS t, '7900' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS v FROM customer
      UNION ALL SELECT c_custkey, 'email', 'u' || c_custkey || '@x.ru' FROM customer WHERE c_custkey % 4 <> 0
      UNION ALL SELECT c_custkey, 'social', 'https://vk.com/u' || c_custkey FROM customer) WHERE c_custkey % 10 > 4
""")
def detail_contacts(spark, sf):
    return parse_details(_details_bodies(spark, sf))[1].select("salon_id", "contact_type", "normalized_value")


def _obs(spark, sf):
    """Sightings of customers by their orders; keys have holes and shared values."""
    o, c = table(spark, sf, "orders"), view(spark, sf, "v_salons")
    joined = o.join(c.drop("external_source"), o["o_custkey"] == c["id"])
    k = F.col("o_orderkey")
    return joined.select(
        k.alias("seq"), "region_id", F.lit("2GIS").alias("external_source"),
        F.when(k % 3 == 0, F.concat(F.lit("x"), F.col("id").cast("string"))).when(k % 3 == 1, F.col("id").cast("string")).alias("external_id"),
        F.when(k % 5 == 0, F.lit("new place")).otherwise(F.col("normalized_name")).alias("normalized_name"),
        F.when(k % 2 == 0, F.col("normalized_address")).alias("normalized_address"),
        F.col("phone").alias("normalized_phone"), "latitude", "longitude")


@query("""
    WITH o AS (SELECT o_orderkey AS seq, s.region_id, CASE o_orderkey % 3 WHEN 0 THEN 'x' || s.id WHEN 1 THEN CAST(s.id AS VARCHAR) END AS ext,
        CASE WHEN o_orderkey % 5 = 0 THEN 'new place' ELSE s.normalized_name END AS name,
        CASE WHEN o_orderkey % 2 = 0 THEN s.normalized_address END AS addr, s.phone, s.latitude, s.longitude
      FROM orders JOIN v_salons s ON o_custkey = s.id),
    hits AS (
      SELECT seq, 0 AS level, s.id FROM o JOIN v_salons s ON s.external_source = '2GIS' AND s.external_id = o.ext
      UNION ALL SELECT seq, 1, s.id FROM o JOIN v_salons s ON s.region_id = o.region_id AND s.normalized_name = o.name AND s.normalized_address = o.addr
      UNION ALL SELECT seq, 2, s.id FROM o JOIN v_salons s ON s.region_id = o.region_id AND s.normalized_name = o.name AND s.phone = o.phone
      UNION ALL SELECT seq, 3, s.id FROM o JOIN v_salons s ON s.region_id = o.region_id AND s.normalized_name = o.name
        AND printf('%.5f', s.latitude) = printf('%.5f', o.latitude) AND printf('%.5f', s.longitude) = printf('%.5f', o.longitude))
    SELECT o.seq, h.entity_id, CAST(h.level AS INT) AS level FROM o LEFT JOIN (
      SELECT seq, min(level) AS level, arg_min(id, CAST(level AS BIGINT) * 1000000000 + id) AS entity_id FROM hits GROUP BY seq) h USING (seq)
""")
def identity_match(spark, sf):
    return match_existing(_obs(spark, sf), view(spark, sf, "v_salons"))


COMPONENTS = """
    WITH RECURSIVE k AS (SELECT c_custkey AS seq, n_regionkey AS r, 'n' || c_custkey // 3 AS name,
        'a' || (c_custkey + 1) // 4 AS addr, CAST(c_custkey // 2 AS VARCHAR) AS phone FROM customer JOIN nation ON c_nationkey = n_nationkey),
    e AS (SELECT a.seq AS s, b.seq AS t FROM k a JOIN k b ON a.r = b.r AND a.name = b.name AND (a.addr = b.addr OR a.phone = b.phone)),
    reach AS (SELECT seq AS s, seq AS t FROM k UNION SELECT reach.s, e.t FROM reach JOIN e ON reach.t = e.s)
    SELECT s AS seq, min(t) AS component FROM reach GROUP BY s
"""


def _linked_obs(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(
        F.col("c_custkey").alias("seq"), F.col("n_regionkey").alias("region_id"),
        F.lit("2GIS").alias("external_source"), F.lit(None).cast("string").alias("external_id"),
        E("'n' || c_custkey div 3").alias("normalized_name"), E("'a' || (c_custkey + 1) div 4").alias("normalized_address"),
        E("cast(c_custkey div 2 as string)").alias("normalized_phone"),
        F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"))


@query(COMPONENTS)
def entity_components(spark, sf):
    return resolve_batch(_linked_obs(spark, sf))


@query("""
    SELECT o_custkey AS entity_id, arg_min(f, o_orderkey) FILTER (WHERE f IS NOT NULL) AS first_priority,
           arg_max(p, o_orderkey) FILTER (WHERE p IS NOT NULL) AS price, arg_max(o_orderstatus, o_orderkey) AS status,
           (arg_max({'v': n}, o_orderkey)).v AS note, CAST(count(*) AS BIGINT) AS n_rows FROM (
      SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS f, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS p,
             CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS n FROM orders) GROUP BY o_custkey
""")
def field_merge(spark, sf):
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("entity_id"), k.alias("seq"), F.when(k % 3 != 0, F.col("o_orderpriority")).alias("first_priority"),
        F.when(k % 4 != 0, F.col("o_totalprice")).alias("price"), F.col("o_orderstatus").alias("status"),
        F.when(k % 5 != 0, F.col("o_orderpriority")).alias("note"))
    return merge_entities(rows, MergePolicy(["first_priority"], ["price"], ["status", "note"]))


CONTACT_STATE = """
    WITH c AS (SELECT salon_id, contact_type, normalized_value, source, arg_max(is_active, id) AS was FROM v_contacts
               WHERE ts < TIMESTAMP '2024-01-16' GROUP BY ALL),
    i AS (SELECT DISTINCT salon_id, contact_type, normalized_value, source FROM v_contacts WHERE ts >= TIMESTAMP '2024-01-16' AND salon_id % 3 <> 0),
    k AS (SELECT DISTINCT salon_id FROM v_contacts WHERE salon_id % 4 <> 1)
    SELECT salon_id, contact_type, normalized_value,
      CASE WHEN i.source IS NOT NULL THEN true WHEN salon_id % 4 <> 1 THEN false ELSE was END AS is_active,
      CASE WHEN i.source IS NOT NULL AND c.source IS NULL THEN 'created' WHEN i.source IS NOT NULL THEN 'updated'
           WHEN salon_id % 4 <> 1 AND was THEN 'deactivated' ELSE 'unchanged' END AS change
    FROM c FULL JOIN i USING (salon_id, contact_type, normalized_value)
"""


def _contact_state(spark, sf):
    v = view(spark, sf, "v_contacts").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    half = F.lit(datetime(2024, 1, 16)).cast("timestamp_ntz")
    key = ["salon_id", "contact_type", "normalized_value", "source"]
    current = v.filter(F.col("ts") < half).groupBy(*key).agg(
        F.max("id").alias("id"), F.max_by("is_active", "id").alias("is_active"), F.max_by("normalized_value", "id").alias("display_value"),
        F.min("ts").alias("first_seen_at"), F.max("ts").alias("last_seen_at"))
    incoming = v.filter((F.col("ts") >= half) & (F.col("salon_id") % 3 != 0)).select(
        *key, F.col("normalized_value").alias("display_value"), F.col("id").alias("pos"))
    checked = v.filter(F.col("salon_id") % 4 != 1).select("salon_id", "source")
    return merge_contacts(current, checked, incoming, as_of())


@query(CONTACT_STATE)
def contact_state(spark, sf):
    return _contact_state(spark, sf).select("salon_id", "contact_type", "normalized_value", "is_active", "change")


@query(f"""
    SELECT contact_type, CAST(count(*) FILTER (WHERE change = 'created') AS BIGINT) AS created,
      CAST(count(*) FILTER (WHERE change = 'updated') AS BIGINT) AS updated, CAST(count(*) FILTER (WHERE change = 'deactivated') AS BIGINT) AS deactivated
    FROM ({CONTACT_STATE}) GROUP BY 1
""")
def contact_state_counts(spark, sf):
    return contact_change_counts(_contact_state(spark, sf), "contact_type")


def _price_results(spark, sf):
    """One result per salon and service: the newest line of later shipments."""
    v = view(spark, sf, "v_prices").filter(F.col("l_shipdate") >= datetime(1998, 1, 1))
    newest = v.groupBy("salon_id", "service_key").agg(F.max_by(F.struct(*[c for c in v.columns if c not in ("salon_id", "service_key")]), "id").alias("r"))
    rows = newest.select("salon_id", "service_key", "r.*")
    status = F.when(F.col("l_linenumber") % 3 == 0, "not_found").when(F.col("price_type") == "ambiguous", "ambiguous").otherwise("found")
    return rows.withColumns({
        "extraction_status": status, "service_name_normalized": F.lower("service_name_raw"), "confidence": F.lit("high")})


def _stored_prices(spark, sf):
    v = view(spark, sf, "v_prices").filter(F.col("l_shipdate") < datetime(1998, 1, 1))
    key = ["salon_id", "service_key", "source_type", "evidence_text"]
    rest = [c for c in v.columns if c not in key]
    one = v.groupBy(*key).agg(F.min_by(F.struct(*rest), "id").alias("r")).select(*key, "r.*")
    return one.withColumns({
        "service_name_normalized": F.lower("service_name_raw"), "confidence": F.lit("low"),
        "first_seen_at": as_of(), "last_seen_at": as_of()}).drop("l_orderkey", "l_linenumber", "l_shipdate")


RESULTS = """
    res AS (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN 'not_found' WHEN price_type = 'ambiguous' THEN 'ambiguous' ELSE 'found' END AS st FROM (
      SELECT *, row_number() OVER (PARTITION BY salon_id, service_key ORDER BY id DESC) AS rn FROM v_prices WHERE l_shipdate >= TIMESTAMP '1998-01-01') WHERE rn = 1)
"""


@query(f"""
    WITH {RESULTS},
    old AS (SELECT salon_id, service_key, evidence_text, arg_min(is_active, id) AS was, arg_min({{'a': amount_minor}}, id).a AS amount
            FROM v_prices WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY ALL),
    new AS (SELECT salon_id, service_key, evidence_text, amount_minor FROM res WHERE st <> 'not_found')
    SELECT salon_id, service_key, evidence_text,
      CASE WHEN new_hit THEN new_amount ELSE amount END AS amount_minor,
      CASE WHEN new_hit THEN true WHEN res_hit THEN false ELSE was END AS is_active,
      CASE WHEN new_hit AND was IS NULL THEN 'created' WHEN new_hit THEN 'updated' WHEN res_hit AND was THEN 'deactivated' ELSE 'unchanged' END AS change
    FROM (SELECT salon_id, service_key, evidence_text, was, amount, n.hit IS NOT NULL AS new_hit, n.amount_minor AS new_amount, r.hit IS NOT NULL AS res_hit
      FROM old FULL JOIN (SELECT *, 1 AS hit FROM new) n USING (salon_id, service_key, evidence_text)
      LEFT JOIN (SELECT salon_id, service_key, 1 AS hit FROM res) r USING (salon_id, service_key))
""")
def price_state(spark, sf):
    merged = merge_prices(_stored_prices(spark, sf), _price_results(spark, sf), as_of())
    return merged.select("salon_id", "service_key", "evidence_text", "amount_minor", "is_active", "change")


@query(f"""
    WITH {RESULTS}
    SELECT s.id, k.service_key, CASE WHEN st = 'found' THEN 'price_found' ELSE coalesce(st, verification_status) END AS verification_status,
      CASE WHEN st = 'found' THEN CASE price_type WHEN 'range' THEN (range_min_minor // 100) || '-' || (range_max_minor // 100)
        WHEN 'from' THEN 'от ' || (amount_minor // 100) ELSE CAST(amount_minor // 100 AS VARCHAR) END END AS service_price,
      CASE WHEN st = 'found' THEN CASE WHEN price_type = 'range' THEN range_min_minor // 100 ELSE amount_minor // 100 END END AS price_min,
      CASE WHEN st = 'found' THEN CASE WHEN price_type = 'range' THEN range_max_minor // 100 ELSE amount_minor // 100 END END AS price_max
    FROM v_salons s CROSS JOIN (SELECT unnest(['basic_manicure_with_coating', 'N', 'R']) AS service_key) k
    LEFT JOIN res r ON r.salon_id = s.id AND r.service_key = k.service_key
""")
def price_summary(spark, sf):
    """The summary of every service in turn: a salon table shows one service."""
    salons = view(spark, sf, "v_salons").select("id", "verification_status").withColumns({
        "service_price": F.lit(None).cast("string"), "price_min": F.lit(None).cast("bigint"), "price_max": F.lit(None).cast("bigint")})
    results = _price_results(spark, sf)
    each = [
        summarize_prices(salons, results.filter(F.col("service_key") == service), as_of()).withColumn("service_key", F.lit(service))
        for service in ("basic_manicure_with_coating", "N", "R")
    ]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query(f"""
    WITH {RESULTS},
    one AS (SELECT salon_id, service_key, evidence_text, amount_minor FROM res WHERE st <> 'not_found')
    SELECT salon_id, service_key, evidence_text, CASE WHEN salon_id % 4 = 2 THEN amount_minor + 100 ELSE amount_minor END AS amount_minor,
      salon_id % 4 <> 0 AS is_active, CASE WHEN salon_id % 2 = 1 THEN 'unchanged' WHEN salon_id % 4 = 2 THEN 'updated' ELSE 'deactivated' END AS change,
      '2024-05-01' AS first_seen, row_number() OVER (ORDER BY salon_id, service_key, evidence_text) AS id FROM one
    UNION ALL
    SELECT salon_id, service_key, evidence_text || ' new', amount_minor + 100, true, 'created', '2024-06-01',
      (SELECT count(*) FROM one) + row_number() OVER (ORDER BY salon_id, service_key, evidence_text) FROM one WHERE salon_id % 4 = 0
""")
def price_state_two_runs(spark, sf):
    """A first run on an empty table, then one that checks the even salons only and finds
    higher prices, every fourth salon's in another place."""
    results = _price_results(spark, sf)
    first = F.lit(datetime(2024, 5, 1)).cast("timestamp_ntz")
    before = merge_prices(_stored_prices(spark, sf).filter("false"), results, first).drop("change")
    again = results.filter("salon_id % 2 = 0").withColumns({
        "amount_minor": F.col("amount_minor") + 100,
        "evidence_text": F.when(F.col("salon_id") % 4 == 0, F.concat("evidence_text", F.lit(" new"))).otherwise(F.col("evidence_text"))})
    merged = merge_prices(before, again, as_of())
    return merged.select(
        "salon_id", "service_key", "evidence_text", "amount_minor", "is_active", "change",
        F.date_format("first_seen_at", "yyyy-MM-dd").alias("first_seen"), "id")


@query("""
    WITH k AS (SELECT salon_id, contact_type, normalized_value, min(id) AS pos, bool_or(id % 2 = 0) AS again FROM v_contacts GROUP BY ALL)
    SELECT salon_id, contact_type, normalized_value, salon_id % 2 = 1 OR again AS is_active,
      CASE WHEN salon_id % 2 = 1 THEN 'unchanged' WHEN again THEN 'updated' ELSE 'deactivated' END AS change,
      row_number() OVER (ORDER BY salon_id, pos) AS id FROM k
""")
def contact_state_two_runs(spark, sf):
    """A first run on an empty table, then one that looks at the even salons and finds some."""
    return _two_contact_runs(spark, sf).select("salon_id", "contact_type", "normalized_value", "is_active", "change", "id")


def _two_contact_runs(spark, sf):
    v = view(spark, sf, "v_contacts")
    incoming = v.select(
        "salon_id", "contact_type", "normalized_value", "source", F.col("normalized_value").alias("display_value"), F.col("id").alias("pos"))
    empty = v.select("salon_id", "contact_type", "normalized_value", "source", "id", "is_active").withColumns({
        "display_value": F.lit(""), "first_seen_at": as_of(), "last_seen_at": as_of()}).filter("false")
    before = merge_contacts(empty, v.select("salon_id", "source"), incoming, as_of()).drop("change")
    even = F.col("salon_id") % 2 == 0
    return merge_contacts(before, v.filter(even).select("salon_id", "source"), incoming.filter(even & (F.col("pos") % 2 == 0)), as_of())


@query(f"""
    WITH {RESULTS},
    k AS (SELECT salon_id, contact_type, normalized_value, min(id) AS pos, bool_or(id % 2 = 0) AS again FROM v_contacts GROUP BY ALL),
    lists AS (SELECT salon_id, coalesce(string_agg(normalized_value, '|' ORDER BY pos) FILTER (WHERE contact_type = 'phone'), '') AS phones
      FROM k WHERE salon_id % 2 = 1 OR again GROUP BY 1),
    price AS (SELECT *, CASE price_type WHEN 'range' THEN (range_min_minor // 100) || '–' || (range_max_minor // 100)
        WHEN 'from' THEN 'от ' || (amount_minor // 100) WHEN 'exact' THEN CAST(amount_minor // 100 AS VARCHAR) END AS shown
      FROM res WHERE st <> 'not_found' AND service_key = 'basic_manicure_with_coating')
    SELECT s.id, coalesce(phones, '') AS phones, shown AS price, coalesce(price_type, 'not_checked') AS price_type
    FROM v_salons s JOIN v_regions r ON r.id = s.region_id LEFT JOIN lists l ON l.salon_id = s.id LEFT JOIN price p ON p.salon_id = s.id
    WHERE filter_status = 'accepted'
""")
def report_after_merge(spark, sf):
    """The accepted report over contacts and prices that the merges themselves made."""
    from placeledger.plans.reports import accepted_report
    from workload.reports import _salons

    prices = merge_prices(_stored_prices(spark, sf).filter("false"), _price_results(spark, sf), as_of()).drop("change")
    contacts = _two_contact_runs(spark, sf).drop("change")
    return accepted_report(_salons(spark, sf), view(spark, sf, "v_regions"), contacts, prices).select(
        "id", F.array_join("phones", "|").alias("phones"), "price", "price_type")


@query("""
    WITH items AS (SELECT 'u' || user_id AS external_id, event_type AS name, ts, event_id, 0 AS pos FROM events
      UNION ALL SELECT 'p' || event_id % 50, event_type || ' ' || user_id % 7, ts, event_id, 1 FROM events)
    SELECT external_id, name AS last_name, CASE WHEN event_id % 2 = 0 THEN 'accepted' ELSE 'rejected' END AS filter_status, n_seen, id
    FROM (SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY ts DESC, event_id DESC) AS rn,
        count(*) OVER (PARTITION BY external_id) AS n_seen FROM items) JOIN
      (SELECT external_id, row_number() OVER (ORDER BY min((ts, event_id, pos))) AS id FROM items GROUP BY 1) USING (external_id)
    WHERE rn = 1
""")
def merge_many_items(spark, sf):
    """Responses of two organisations each, numbered by arrival and merged into an empty table."""
    from placeledger import schemas
    from placeledger.operators.merge import merge_sightings

    kind = F.array(F.struct(F.when(F.col("event_id") % 2 == 0, "Маникюр").otherwise("Кафе").alias("name")))
    one = F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"), F.concat(F.lit("Студия "), "event_type").alias("name"), kind.alias("rubrics"))
    two = F.struct(
        F.concat(F.lit("p"), (F.col("event_id") % 50).cast("string")).alias("id"),
        F.concat(F.lit("Студия "), "event_type", F.lit(" "), (F.col("user_id") % 7).cast("string")).alias("name"), kind.alias("rubrics"))
    responses = spread(table(spark, sf, "events")).select(
        F.col("event_id").alias("grid_cell_id"), F.lit(1).cast("bigint").alias("region_id"), F.lit("q").alias("query"), F.lit(1).alias("page"),
        F.lit("u").alias("source_url"), F.col("ts").cast("timestamp_ntz").alias("fetched_at"),
        F.to_json(F.struct(F.struct(F.array(one, two).alias("items")).alias("result"))).alias("body"))
    merged, decided = merge_sightings(spark.createDataFrame([], schemas.SALON), parse_search(responses)[0], as_of())
    seen = decided.groupBy(F.col("entity_id").alias("id")).agg(F.count("*").alias("n_seen"))
    return merged.join(seen, "id").select(
        "external_id", F.regexp_replace("name", "^Студия ", "").alias("last_name"), "filter_status", "n_seen", "id")


@query("""
    SELECT salon_id, id, CAST(page AS INT) AS page FROM (SELECT o_custkey AS salon_id, o_orderkey AS id,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS page FROM orders WHERE o_orderstatus <> 'F') WHERE page <= 3
""")
def latest_payloads_per_salon(spark, sf):
    details = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("salon_id"),
        F.when(F.col("o_orderstatus") == "F", "error").otherwise("success").alias("status"),
        F.col("o_orderpriority").alias("raw_payload_json"), F.lit("u").alias("sanitized_source_url"))
    return latest_payloads(details).select("salon_id", "id", "page")


def _dealt_pages(spark, sf, salons):
    """Every row of `pages` as a page of one salon that is priced by its pages' texts, in turn;
    a salon for which there is no page has one without html."""
    sites = salons.filter("website IS NOT NULL AND id % 6 = 4 AND coalesce(filter_status, 'accepted') = 'accepted'")
    sites = number_rows(sites.select(F.col("id").alias("salon_id"), F.col("website").alias("source_url")), "_site", "salon_id")
    n = F.lit(max(sites.count(), 1)).cast("bigint")
    dealt = table(spark, sf, "pages").select(
        F.pmod(F.coalesce("page_id", F.lit(0)), n).alias("_site"), F.floor(F.col("page_id") / n).alias("_turn"), "html")
    return sites.join(dealt, "_site", "left").select(
        "salon_id", (F.coalesce("_turn", F.lit(0)) + 1).alias("page_no"), "source_url", "html")


@query("""
    WITH d AS (SELECT o_custkey AS s, o_orderkey AS id, o_orderstatus AS st, o_totalprice AS p FROM orders),
    latest AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY id DESC) AS rn FROM d WHERE st <> 'F'),
    prov AS (SELECT s, arg_min(floor(p), rn) FILTER (WHERE id % 3 = 0) AS amount, count(*) FILTER (WHERE id % 3 = 1) > 0 AS amb FROM latest WHERE rn <= 3 GROUP BY s)
    SELECT id AS salon_id,
      CASE WHEN prov.amount IS NOT NULL THEN 'found' WHEN website IS NULL THEN CASE WHEN amb THEN 'ambiguous' ELSE 'not_found' END
           WHEN id % 6 = 0 THEN 'error' ELSE 'found' END AS status,
      CAST(CASE WHEN prov.amount IS NOT NULL THEN prov.amount * 100 WHEN website IS NOT NULL AND id % 6 = 2 THEN (500 + id) * 100
        WHEN website IS NOT NULL AND id % 6 = 4 THEN 70000 END AS BIGINT) AS amount_minor,
      CASE WHEN prov.amount IS NOT NULL THEN 'provider_structured' WHEN website IS NULL THEN CASE WHEN amb THEN 'provider_structured' ELSE 'none' END
           WHEN id % 6 = 0 THEN NULL WHEN id % 6 = 2 THEN 'website_json_ld' ELSE 'website_text' END AS source_type
    FROM v_salons LEFT JOIN prov ON prov.s = id WHERE coalesce(filter_status, 'accepted') = 'accepted'
""")
def extracted_prices(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    name = F.when(k % 3 == 0, "Маникюр с покрытием").when(k % 3 == 1, "Покрытие гель лак").otherwise("Массаж")
    service = F.struct(name.alias("name"), F.floor("o_totalprice").alias("price"))
    payload = F.to_json(F.struct(F.struct(F.array(F.struct(F.array(service).alias("services"))).alias("items")).alias("result")))
    details = o.select(
        k.alias("id"), F.col("o_custkey").alias("salon_id"), F.when(F.col("o_orderstatus") == "F", "error").otherwise("success").alias("status"),
        F.lit("u").alias("sanitized_source_url"), payload.alias("raw_payload_json"))
    salons = view(spark, sf, "v_salons")
    ld = F.concat(
        F.lit('<p>Часы 9-21</p><script type="application/ld+json">{"@graph":[{"name":"Маникюр с покрытием","offers":{"price":"'),
        (F.col("id") + 500).cast("string"), F.lit('"}}]}</script>'))
    # A third of the sites are pages of the table, each with one priced line put before its text.
    line = F.concat(F.lit("<p>Маникюр с покрытием 700 руб</p>"), F.coalesce("html", F.lit("")))
    own = salons.filter("website IS NOT NULL").select(
        F.col("id").alias("salon_id"), F.lit(1).cast("bigint").alias("page_no"), F.col("website").alias("source_url"),
        F.when(F.col("id") % 6 == 2, ld).alias("html"), F.when(F.col("id") % 6 == 0, "timeout").alias("fetch_error"))
    pages = own.filter("salon_id % 6 <> 4").unionByName(
        _dealt_pages(spark, sf, salons).withColumns({"html": line, "fetch_error": F.lit(None).cast("string")}))
    return extract_prices(salons, details, pages, as_of()).select(
        "salon_id", F.col("extraction_status").alias("status"), "amount_minor", "source_type")


RULES = {
    "strong_category": ["machinery", "building"], "allowed_category": ["household"], "unrelated": ["furniture"],
    "nail_name": ["customer 00000000"], "beauty_name": ["00000001"], "generic_name": ["0000002"], "nail_studio_name": ["000000015"],
    "home_master": ["street 7"], "coworking": ["street 13"], "training": ["street 3"], "supply": ["street 4"],
}


@query("""
    WITH t AS (SELECT id, filter_status, business_profile, rejection_reason, classifier_version, lower(segment) AS c,
        normalized_name AS n, normalized_name || ' ' || lower(segment) || ' ' || normalized_address AS a FROM v_salons
        WHERE classifier_version IS DISTINCT FROM 'v2'),
    s AS (SELECT *, contains(n, 'customer 00000000') AS nail, contains(n, '00000001') OR contains(n, '0000002') AS named,
        c IN ('machinery', 'building') AS strong, c = 'household' AS allowed, c = 'furniture' AS other FROM t),
    d AS (SELECT *, CASE WHEN contains(a, 'street 13') THEN 'coworking_or_rental' WHEN contains(a, 'street 7') THEN 'home_or_private_master'
        WHEN NOT (strong OR nail) THEN 'no_manicure_signal' WHEN contains(a, 'street 3') AND NOT allowed AND NOT (named OR nail) THEN 'training_only'
        WHEN contains(a, 'street 4') AND NOT allowed AND NOT named THEN 'beauty_supply_without_service'
        WHEN nail OR named THEN NULL WHEN allowed AND NOT other THEN NULL WHEN allowed THEN 'mixed_non_salon' WHEN strong THEN NULL
        ELSE 'no_salon_or_studio_signal' END AS why FROM s),
    p AS (SELECT *, CASE WHEN why IS NOT NULL THEN 'unknown' WHEN nail THEN 'nail_specialist'
        WHEN named AND contains(n, '000000015') THEN 'nail_specialist' WHEN named THEN 'mixed_beauty_salon' WHEN allowed THEN 'mixed_beauty_salon' ELSE 'nail_specialist' END AS profile FROM d)
    SELECT id, CASE WHEN why IS NULL THEN 'accepted' ELSE 'rejected' END AS new_status, profile AS business_profile, why AS rejection_reason,
      filter_status IS DISTINCT FROM CASE WHEN why IS NULL THEN 'accepted' ELSE 'rejected' END OR business_profile IS DISTINCT FROM profile
      OR rejection_reason IS DISTINCT FROM why AS changed FROM p
""")
def reclassify_diff(spark, sf):
    salons = view(spark, sf, "v_salons").withColumns({
        "raw_payload": F.lit("{}"), "categories": F.array("segment"), "description": F.lit(None).cast("string")})
    return reclassify(salons, "v2", RULES).select("id", "new_status", "business_profile", "rejection_reason", "changed")


def _decided_half(spark, sf):
    salons = view(spark, sf, "v_salons").select("id", "filter_status", "business_profile", "classifier_version")
    decided = salons.filter("id % 2 = 0").select("id").withColumns({
        "accepted": F.lit(True), "confidence": F.lit(0.9), "reason_codes": F.array(F.lit("r")), "business_profile": F.lit("nail_specialist"),
        "rejection_reason": F.lit(None).cast("string"), "decision_name": F.lit("n"), "decision_categories": F.array(F.lit("c")),
        "input_snapshot": F.lit("{}")})
    return salons, decided


@query("""
    SELECT id, CASE WHEN id % 2 = 0 THEN 'accepted' ELSE filter_status END AS filter_status,
      CASE WHEN id % 2 = 0 THEN 'v9' ELSE classifier_version END AS classifier_version,
      CASE WHEN id % 2 = 0 THEN 'nail_specialist' ELSE business_profile END AS business_profile FROM v_salons
""")
def classification_applied(spark, sf):
    return apply_classification(*_decided_half(spark, sf), "v9", as_of())[0]


@query("""
    SELECT id AS salon_id, 'v9' AS classifier_version, id % 4 = 0 AS accepted, CASE WHEN id % 4 = 0 THEN 'nail_specialist' ELSE 'unrelated' END AS business_profile,
      'r' || id % 3 || ',' || segment AS reasons, CASE WHEN id % 4 <> 0 THEN 'why ' || segment END AS rejection_reason,
      '{"name":"' || name || '"}' AS input_snapshot, TIMESTAMP '2024-06-01 00:00:00' AS classified_at FROM v_salons WHERE id % 2 = 0
""")
def classification_audit(spark, sf):
    """The audit rows that a run of the classifier appends."""
    yes = F.col("id") % 4 == 0
    salons = view(spark, sf, "v_salons")
    decided = salons.filter("id % 2 = 0").select(
        "id", yes.alias("accepted"), F.lit(0.9).alias("confidence"),
        F.array(F.concat(F.lit("r"), (F.col("id") % 3).cast("string")), "segment").alias("reason_codes"),
        F.when(yes, "nail_specialist").otherwise("unrelated").alias("business_profile"),
        F.when(~yes, F.concat(F.lit("why "), "segment")).alias("rejection_reason"),
        F.col("name").alias("decision_name"), F.array("segment").alias("decision_categories"),
        F.to_json(F.struct("name")).alias("input_snapshot"))
    audit = apply_classification(salons.select("id", "filter_status"), decided, "v9", as_of())[1]
    return audit.withColumn("reasons", F.array_join("reason_codes", ",")).drop("reason_codes")


@query("""
    SELECT s.id, CASE WHEN id % 10 > 4 THEN s.name ELSE s.name END AS name,
      CASE WHEN id % 10 > 4 THEN CASE WHEN id % 2 = 0 THEN 'Full ' || id ELSE segment END ELSE address END AS address,
      CASE id % 10 WHEN 0 THEN 'not_found' WHEN 1 THEN 'unauthorized' WHEN 2 THEN 'parser_error' WHEN 3 THEN 'rate_limited'
        WHEN 4 THEN 'transient_error' ELSE 'success' END AS details_status FROM v_salons s
""")
def details_applied(spark, sf):
    details, _, outcomes = parse_details(_details_bodies(spark, sf))
    salons = view(spark, sf, "v_salons").select("id", "name", "address", "details_status", "details_enriched_at")
    return apply_details(salons, details, outcomes, as_of()).select("id", "name", "address", "details_status")


def _discoveries(spark, sf):
    return view(spark, sf, "v_disc").withColumns({
        "classifier_reason_codes": F.array(F.coalesce("rejection_reason", F.lit("ok"))),
        "filter_reasons": F.lit(None).cast("array<string>"), "filter_confidence": F.lit(0.5)})


@query("""
    WITH g AS (SELECT external_id, filter_status, rejection_reason, business_profile, CAST(count(*) AS BIGINT) AS n, min(id) AS first_id, max(id) AS last_id,
        string_agg(DISTINCT query, ',' ORDER BY query) AS queries FROM v_disc GROUP BY ALL)
    SELECT external_id, count(*) > 1 AS conflict, CAST(sum(n) AS BIGINT) AS observations,
      string_agg(filter_status || ':' || coalesce(rejection_reason, '-') || ':' || n || ':' || first_id || ':' || last_id || ':' || queries, ';' ORDER BY first_id) AS decisions
    FROM g GROUP BY external_id
""")
def conflicts(spark, sf):
    report = conflict_report(_discoveries(spark, sf))
    shown = F.transform("decisions", lambda d: F.concat_ws(
        ":", d["filter_status"], F.coalesce(d["rejection_reason"], F.lit("-")), d["n"].cast("string"),
        d["first_discovery_id"].cast("string"), d["last_discovery_id"].cast("string"), F.array_join(d["queries"], ",")))
    return report.select("external_id", "conflict", "observations", F.array_join(shown, ";").alias("decisions"))


@query("""
    WITH rej AS (SELECT DISTINCT external_id FROM v_disc WHERE filter_status = 'rejected' AND trim(external_id) <> ''),
    h AS (SELECT d.* FROM v_disc d JOIN rej USING (external_id)),
    l AS (SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY id DESC) AS rn FROM h),
    a AS (SELECT external_id, CAST(count(*) AS BIGINT) AS obs, CAST(count(DISTINCT grid_cell_id) AS BIGINT) AS cells,
            count(DISTINCT filter_status || coalesce(rejection_reason, '') || business_profile) > 1 AS conflicting FROM h GROUP BY 1)
    SELECT l.external_id, l.id AS discovery_id, s.id AS previous_salon_id, s.filter_status AS previous_status, l.filter_status AS new_status,
      CASE WHEN s.id IS NULL THEN 'create' WHEN s.filter_status IS DISTINCT FROM l.filter_status OR s.rejection_reason IS DISTINCT FROM l.rejection_reason
        OR s.business_profile IS DISTINCT FROM l.business_profile THEN 'update' ELSE 'unchanged' END AS action,
      a.obs AS observation_count, a.cells AS distinct_cells, a.conflicting AS conflicting_decisions, 'Org ' || l.cust AS name
    FROM l JOIN a USING (external_id) LEFT JOIN v_salons s ON s.external_source = '2GIS' AND s.external_id = l.external_id WHERE rn = 1
""")
def backfill_actions(spark, sf):
    disc = _discoveries(spark, sf)
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.to_json(F.struct(F.concat(F.lit("Org "), F.col("o_custkey").cast("string")).alias("name"))).alias("payload"),
        F.lit("x").alias("name"), F.col("o_orderdate").cast("timestamp_ntz").alias("fetched_at"))
    salons = view(spark, sf, "v_salons").withColumn(
        "classifier_reason_codes", F.array(F.when(F.col("filter_status") == "accepted", "ok").otherwise(F.col("rejection_reason"))))
    plan = backfill_plan(disc.drop("cust", "price", "fetched_at"), raw, salons)
    return plan.select("external_id", "discovery_id", "previous_salon_id", "previous_status", "new_status", "action",
                       "observation_count", "distinct_cells", "conflicting_decisions", "name")


@query("""
    SELECT d.id, coalesce(d.salon_id, s.id) AS salon_id FROM v_disc d LEFT JOIN v_salons s
      ON s.external_source = d.external_source AND s.external_id = d.external_id
""")
def discovery_backlink(spark, sf):
    return link_discoveries(_discoveries(spark, sf), view(spark, sf, "v_salons")).select("id", "salon_id")


@query("""
    WITH w AS (SELECT c_custkey AS name, unnest([0, 1, 2]) AS priority FROM customer),
    k AS (SELECT name, priority, CASE priority WHEN 0 THEN 'iso' ELSE CASE priority WHEN 1 THEN 'name:ru' ELSE 'name' END END AS kind,
        CASE priority WHEN 0 THEN 'i' || name % 700 ELSE 'n' || name % 900 END AS key FROM w),
    c AS (SELECT 'iso' AS kind, 'i' || o_orderkey % 20011 AS key, o_orderkey AS id FROM orders
      UNION ALL SELECT 'name', 'n' || o_orderkey % 15013, o_orderkey FROM orders),
    n AS (SELECT kind, key, count(DISTINCT id) AS n, min(id) AS id FROM c GROUP BY ALL),
    h AS (SELECT k.name, k.priority, n.n, n.id FROM k JOIN n USING (kind, key)),
    b AS (SELECT name, arg_min(n, priority) AS n, arg_min(id, priority) AS id FROM h GROUP BY name)
    SELECT CAST(c_custkey AS VARCHAR) AS name, CASE WHEN n IS NULL THEN 'unresolved' WHEN n > 1 THEN 'ambiguous' ELSE 'resolved' END AS status,
      CASE WHEN n = 1 THEN id END AS id FROM customer LEFT JOIN b ON b.name = c_custkey
""")
def key_resolution(spark, sf):
    i = F.col("c_custkey")
    text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    meta = table(spark, sf, "customer").select(i.cast("string").alias("key_name"), text("i", i % 700).alias("iso3166_2"), text("n", i % 900).alias("name"))
    # Names repeat here, so the row key travels with the lookup keys.
    wanted = region_keys(meta.select(F.concat_ws("|", "key_name", "name").alias("name"), "iso3166_2")).select(
        F.split("name", r"\|")[0].alias("name"), "priority", "kind",
        F.when(F.col("kind") == "iso", F.col("key")).otherwise(F.split("key", r"\|")[1]).alias("key"))
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    candidates = o.select(F.lit("iso").alias("kind"), text("i", k % 20011).alias("key"), k.alias("id")).unionByName(
        o.select(F.lit("name").alias("kind"), text("n", k % 15013).alias("key"), k.alias("id")))
    return resolve_keys(wanted, candidates).select("name", "status", "id")


@query("""
    SELECT coalesce(a.c_name, b.name) AS name, c_custkey AS id, coalesce(b.o, -c_custkey) AS scan_order, CASE WHEN c_custkey IS NULL THEN 'pending' ELSE a.c_mktsegment END AS status
    FROM (SELECT * FROM customer WHERE c_custkey % 3 <> 0) a FULL JOIN (SELECT c_name AS name, c_custkey * 10 AS o FROM customer WHERE c_custkey % 2 = 0) b ON a.c_name = b.name
""")
def region_sync(spark, sf):
    c = table(spark, sf, "customer")
    current = c.filter("c_custkey % 3 <> 0").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_custkey").alias("scan_order"), F.col("c_mktsegment").alias("status"))
    listed = c.filter("c_custkey % 2 = 0").select(F.col("c_name").alias("name"), (F.col("c_custkey") * 10).alias("scan_order"))
    return sync_regions(current, listed)


@query("""
    SELECT c_custkey AS id, c_name AS name, 'pending' AS status FROM customer
    UNION ALL SELECT s_suppkey, s_name, 'new' FROM supplier
""")
def schema_evolve(spark, sf):
    old = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    new = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("new").alias("status"))
    return union_evolved(old, new, {"status": "pending"})
