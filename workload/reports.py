"""Cell, report, comparison, spatial and streaming queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from placeledger.functions import geo
from placeledger.operators import cells as C
from placeledger.operators.compare import compare_profiles, profile_differences, profile_ids
from placeledger.operators.eligibility import (
    due_for_enrichment,
    due_for_pricing,
    due_for_reclassification,
    next_regions,
    pricing_eligible,
)
from placeledger.operators.grid import grid_cells, grid_counts, longitude_stats
from placeledger.operators.nearby import points_within
from placeledger.operators.stage import spread
from placeledger.plans import reports as R
from placeledger.session import run_dir
from placeledger.sources.dimensions import query_list, scan_plan
from placeledger.streaming import flows
from workload.registry import query
from workload.views import table, view


def as_of():
    return F.lit(datetime(2024, 6, 1)).cast("timestamp_ntz")


@query("""
    SELECT region_id, status, CAST(count(*) AS BIGINT) AS n FROM v_cells GROUP BY ALL
""")
def cell_status_counts(spark, sf):
    return C.status_counts(view(spark, sf, "v_cells"))


@query("""
    SELECT region_id, CAST(count(*) FILTER (WHERE filter_status = 'accepted') AS BIGINT) AS accepted,
      CAST(count(*) FILTER (WHERE filter_status = 'rejected') AS BIGINT) AS rejected FROM v_salons GROUP BY 1
""")
def accepted_by_region(spark, sf):
    return C.accepted_per_region(view(spark, sf, "v_salons"))


@query("""
    WITH c AS (SELECT region_id, count(*) AS total, count(*) FILTER (WHERE status IN ('pending', 'in_progress')) AS open,
        count(*) FILTER (WHERE status = 'completed') AS done, count(*) FILTER (WHERE status = 'failed') AS failed FROM v_cells GROUP BY 1),
    s AS (SELECT region_id, count(*) FILTER (WHERE filter_status = 'accepted') AS acc, count(*) FILTER (WHERE filter_status = 'rejected') AS rej FROM v_salons GROUP BY 1),
    j AS (SELECT r.id, r.name, r.status, coalesce(g.status = 'complete', false) AND coalesce(open, 0) = 0 AS closed, coalesce(total, 0) AS total,
        coalesce(done, 0) AS done, coalesce(failed, 0) AS failed, coalesce(acc, 0) AS acc, coalesce(rej, 0) AS rej
      FROM v_regions r LEFT JOIN v_grids g ON g.region_id = r.id LEFT JOIN c ON c.region_id = r.id LEFT JOIN s ON s.region_id = r.id)
    SELECT id AS region_id, name, closed, CASE WHEN closed THEN 'completed' ELSE status END AS status, total AS total_cells, done AS completed_cells,
      acc AS salons_found, CASE WHEN closed THEN 'Rejected salons: ' || rej || '; failed cells: ' || failed END AS comment FROM j
""")
def region_completion(spark, sf):
    v = lambda n: view(spark, sf, n)
    return C.region_completion(v("v_regions"), v("v_grids"), v("v_cells"), v("v_salons"))


@query("""
    SELECT g.region_id, n AS actual_cells, CASE WHEN status <> 'complete' THEN 'not_complete' WHEN cell_size_meters <> 1500 THEN 'cell_size_changed'
      WHEN n <> expected_cells OR persisted_cells <> expected_cells THEN 'count_mismatch' END AS reason
    FROM v_grids g LEFT JOIN (SELECT region_id, count(*) AS n FROM v_cells GROUP BY 1) c USING (region_id)
""")
def grid_audit(spark, sf):
    return C.audit_grids(view(spark, sf, "v_grids"), view(spark, sf, "v_cells"), 1500, "v1").select("region_id", "actual_cells", "reason")


@query("""
    SELECT id, CASE WHEN id % 6 = 0 THEN 'completed' WHEN id % 6 = 3 THEN CASE WHEN attempts < 3 THEN 'pending' ELSE 'failed' END
      WHEN status = 'in_progress' AND attempts < 3 THEN 'pending' ELSE status END AS status FROM v_cells
""")
def cell_outcomes(spark, sf):
    cells = view(spark, sf, "v_cells")
    # Two attempts each; the later one counts.
    i = F.col("id")
    attempts = cells.filter(i % 3 == 0).select(
        i.alias("grid_cell_id"), F.explode(F.array(
            F.struct((i * 2).alias("id"), F.lit("failed").alias("status")),
            F.struct((i * 2 + 1).alias("id"), F.when(i % 6 == 0, "complete").otherwise("failed").alias("status")))).alias("a"),
    ).select("grid_cell_id", "a.*")
    return C.settle_cells(cells, attempts, 3).select("id", "status")


@query("""
    SELECT id, q AS query, CAST(p AS INT) AS query_pos FROM v_cells, (SELECT unnest(['маникюр', 'nail studio']) AS q, unnest([0, 1]) AS p)
""")
def scan_tasks(spark, sf):
    return scan_plan(view(spark, sf, "v_cells"), query_list("reduced_ru_en_v1")[1]).select("id", "query", "query_pos")


@query("""
    SELECT grid_cell_id, CAST(count(*) AS BIGINT) AS raw_organizations_found, CAST(count(*) FILTER (WHERE filter_status = 'accepted') AS BIGINT) AS accepted_salons,
      CAST(count(*) FILTER (WHERE filter_status = 'rejected') AS BIGINT) AS rejected_results, CAST(count(*) FILTER (WHERE id % 4 = 0) AS BIGINT) AS duplicates_merged
    FROM v_disc GROUP BY 1
""")
def attempt_rollup(spark, sf):
    return C.attempt_rollup(view(spark, sf, "v_disc").withColumn("merged", F.col("id") % 4 == 0))


@query("""
    SELECT CAST(count(DISTINCT grid_cell_id) AS BIGINT) AS cells_attempted, CAST(count(*) AS BIGINT) AS raw_organizations_found,
      CAST(count(*) FILTER (WHERE filter_status = 'accepted') AS BIGINT) AS accepted_salons, CAST(count(*) FILTER (WHERE filter_status = 'rejected') AS BIGINT) AS rejected_results,
      CAST(count(*) FILTER (WHERE id % 4 = 0) AS BIGINT) AS duplicates_merged,
      CAST(greatest(0, count(*) FILTER (WHERE filter_status = 'accepted') - count(*) FILTER (WHERE id % 4 = 0)) AS BIGINT) AS salons_created,
      CAST(2 AS BIGINT) AS cells_completed FROM v_disc
""")
def run_metrics(spark, sf):
    return C.run_metrics(attempt_rollup(spark, sf), 3, 5)


@query("""
    SELECT id, cell_order AS scan_order FROM v_cells WHERE status IN ('in_progress', 'pending') ORDER BY CASE WHEN status = 'in_progress' THEN 0 ELSE 1 END, cell_order LIMIT 30
""")
def next_open_regions(spark, sf):
    regions = view(spark, sf, "v_cells").withColumnRenamed("cell_order", "scan_order")
    return next_regions(regions, 30).select("id", "scan_order")


@query("""
    SELECT id, region_id FROM (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY cell_order) AS rn FROM v_cells WHERE status = 'pending' AND attempts < 3) WHERE rn <= 5
""")
def next_open_cells(spark, sf):
    return C.next_cells(view(spark, sf, "v_cells"), 3, 5).select("id", "region_id")


@query("""
    SELECT id, pos FROM (SELECT c.id, c.id * 7 % 1000 AS pos, row_number() OVER (PARTITION BY region_id ORDER BY c.id * 7 % 1000, cell_order) AS rn
      FROM v_cells c WHERE status = 'pending' AND attempts < 3 AND c.id % 8 = 0) WHERE rn <= 2
""")
def allowed_cells(spark, sf):
    cells = view(spark, sf, "v_cells")
    allow = cells.filter("id % 8 = 0").select("id", (F.col("id") * 7 % 1000).alias("pos"))
    return C.next_cells(cells, 3, 2, allow).select("id", (F.col("id") * 7 % 1000).alias("pos"))


@query("""
    SELECT c_custkey AS id, CASE WHEN c.id IS NULL THEN 'missing' WHEN status <> 'pending' THEN 'not_pending' END AS problem
    FROM customer LEFT JOIN (SELECT * FROM v_cells WHERE region_id = 1) c ON c.id = c_custkey
""")
def allowlist_check(spark, sf):
    allow = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("pos"))
    return C.ordered_allowlist(view(spark, sf, "v_cells"), allow, 1).select("id", "problem")


ENRICH = """
    lower(coalesce(external_source, source)) = '2gis' AND trim(external_id) <> '' AND coalesce(filter_status, 'accepted') = 'accepted'
    AND (details_enriched_at IS NULL OR details_status IS DISTINCT FROM 'success' OR details_enriched_at <= TIMESTAMP '2024-06-01' - INTERVAL 120 DAY)
"""


@query(f"SELECT id FROM v_salons WHERE {ENRICH} ORDER BY id LIMIT 50")
def next_to_enrich(spark, sf):
    return due_for_enrichment(view(spark, sf, "v_salons"), as_of(), 120, 50).select("id")


@query("""
    SELECT id FROM v_salons WHERE coalesce(filter_status, 'accepted') = 'accepted' ORDER BY CASE WHEN verification_status = 'not_checked' THEN 0 ELSE 1 END, id LIMIT 400
""")
def next_to_price(spark, sf):
    return due_for_pricing(view(spark, sf, "v_salons"), 400).select("id")


@query("SELECT id FROM v_salons WHERE classifier_version IS DISTINCT FROM 'v2' ORDER BY id LIMIT 100")
def next_to_reclassify(spark, sf):
    return due_for_reclassification(view(spark, sf, "v_salons"), "v2", 100).select("id")


@query("""
    SELECT id FROM v_salons s WHERE filter_status = 'accepted' AND (website IS NOT NULL
      OR EXISTS (SELECT 1 FROM v_contacts c WHERE c.salon_id = s.id AND is_active AND contact_type = 'website')
      OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = s.id AND o_orderstatus = 'F'))
""")
def pricing_eligible_salons(spark, sf):
    details = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("salon_id"), F.when(F.col("o_orderstatus") == "F", "success").otherwise("error").alias("status"))
    return pricing_eligible(view(spark, sf, "v_salons"), view(spark, sf, "v_contacts"), details).select("id")


DIST = """sqrt(pow(radians({a} - {c}) * 6371008.8, 2) + pow(radians({b} - {d}) * 6371008.8 * cos(radians(({a} + {c}) / 2)), 2))"""


@query(f"""
    SELECT id, round(d, 3) AS distance_m FROM (SELECT id, cell_order, {DIST.format(a='center_lat', b='center_lon', c='55.5', d='30.25')} AS d FROM v_cells
      WHERE status = 'pending' AND id % 16 <> 0) ORDER BY d, cell_order LIMIT 25
""")
def nearest_pending_cells(spark, sf):
    cells = view(spark, sf, "v_cells")
    near = C.nearest_cells(cells, 55.5, 30.25, 25, cells.filter("id % 16 = 0").select("id"))
    return near.select("id", F.round("distance_m", 3).alias("distance_m"))


@query(f"""
    SELECT s_suppkey AS centre, id AS point, round({DIST.format(a='latitude', b='longitude', c='lat', d='lon')}, 3) AS distance_m
    FROM (SELECT s_suppkey, 50 + s_suppkey % 97 / 7.0 AS lat, 20 + s_suppkey % 89 / 3.0 AS lon FROM supplier), v_salons
    WHERE {DIST.format(a='latitude', b='longitude', c='lat', d='lon')} <= 60000
""")
def salons_in_radius(spark, sf):
    k = F.col("s_suppkey")
    centres = table(spark, sf, "supplier").select(
        k.alias("centre"), (50 + k % 97 / 7.0).cast("double").alias("lat"), (20 + k % 89 / 3.0).cast("double").alias("lon"))
    points = view(spark, sf, "v_salons").select(F.col("id").alias("point"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    found = points_within(centres, points, 60000, "centre", "point")
    return found.select("centre", "point", F.round("distance_m", 3).alias("distance_m"))


PROFILES = """
    p AS (SELECT grid_cell_id AS cell_id, CASE WHEN id % 3 = 0 THEN 'reduced' ELSE 'full' END AS profile, nullif(trim(external_id), '') AS e,
        filter_status = 'accepted' AS acc, id FROM v_disc),
    i AS (SELECT cell_id, e, arg_max(acc, id) FILTER (WHERE profile = 'full') AS f, arg_max(acc, id) FILTER (WHERE profile = 'reduced') AS r
        FROM p WHERE e IS NOT NULL GROUP BY ALL)
"""


def _profile_ids(spark, sf):
    disc = view(spark, sf, "v_disc")
    sightings = disc.select(
        F.col("grid_cell_id").alias("cell_id"), F.when(F.col("id") % 3 == 0, "reduced").otherwise("full").alias("profile"),
        F.trim("external_id").alias("external_id"), (F.col("filter_status") == "accepted").alias("accepted"), F.col("id").alias("seq"))
    return profile_ids(sightings, "full", "reduced")


@query(f"""
    WITH {PROFILES} SELECT cell_id, CAST(count(f) AS BIGINT) AS full_ids, CAST(count(r) AS BIGINT) AS reduced_ids,
      CAST(count(*) FILTER (WHERE f IS NOT NULL AND r IS NOT NULL) AS BIGINT) AS common,
      CAST(count(*) FILTER (WHERE f IS NOT NULL AND r IS NULL) AS BIGINT) AS missing_from_reduced,
      CAST(count(*) FILTER (WHERE f IS NULL) AS BIGINT) AS extra_in_reduced,
      CAST(count(*) FILTER (WHERE f AND r IS NULL) AS BIGINT) AS accepted_missing,
      CAST(count(*) FILTER (WHERE NOT f AND r IS NULL) AS BIGINT) AS rejected_missing,
      round(count(*) FILTER (WHERE f IS NOT NULL AND r IS NOT NULL) / count(*), 9) AS jaccard FROM i GROUP BY 1
""")
def profile_compare(spark, sf):
    return compare_profiles(_profile_ids(spark, sf)).withColumn("jaccard", F.round("jaccard", 9))


@query(f"""
    WITH {PROFILES} SELECT cell_id, e AS external_id, CASE WHEN r IS NULL THEN 'missing_from_reduced' ELSE 'extra_in_reduced' END AS side, coalesce(f, r) AS accepted
    FROM i WHERE f IS NULL OR r IS NULL
""")
def profile_difference_rows(spark, sf):
    return profile_differences(_profile_ids(spark, sf))


def _salons(spark, sf):
    return view(spark, sf, "v_salons").withColumns({
        "first_seen_at": F.col("first_seen_text"), "created_at": F.lit(None).cast("string"), "last_seen_at": F.col("last_seen_text"),
        "updated_at": F.lit(None).cast("string"), "masters_count": F.lit(None).cast("string"),
        "classifier_reason_codes": F.array("rejection_reason"), "classified_at": F.col("last_seen_text")})


def _contacts(spark, sf):
    return view(spark, sf, "v_contacts").withColumn("display_value", F.col("normalized_value"))


LISTS = """
    u AS (SELECT salon_id, CASE contact_type WHEN 'phone' THEN 'p' WHEN 'website' THEN 'l' WHEN 'social' THEN 'l' END AS kind, normalized_value AS v,
        min(contact_type || lpad(CAST(id AS VARCHAR), 12, '0')) AS place FROM v_contacts WHERE is_active GROUP BY ALL),
    lists AS (SELECT salon_id, coalesce(string_agg(v, '|' ORDER BY place) FILTER (WHERE kind = 'p'), '') AS phones,
        coalesce(string_agg(v, '|' ORDER BY place) FILTER (WHERE kind = 'l'), '') AS links FROM u GROUP BY 1),
    price AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY salon_id ORDER BY id DESC) AS rn FROM v_prices
        WHERE is_active AND service_key = 'basic_manicure_with_coating') WHERE rn = 1),
    acc AS (SELECT s.*, r.name AS region, r.scan_order, coalesce(l.phones, '') AS phones, coalesce(l.links, '') AS links, l.salon_id IS NOT NULL AS reached,
        p.price_type, p.currency, coalesce(p.price_type, CASE WHEN verification_status IN ('not_found', 'ambiguous', 'error') THEN verification_status ELSE 'not_checked' END) AS st,
        CASE p.price_type WHEN 'range' THEN (range_min_minor // 100) || '–' || (range_max_minor // 100) WHEN 'from' THEN 'от ' || (amount_minor // 100)
          WHEN 'exact' THEN CAST(amount_minor // 100 AS VARCHAR) END AS price
      FROM v_salons s JOIN v_regions r ON r.id = s.region_id LEFT JOIN lists l ON l.salon_id = s.id LEFT JOIN price p ON p.salon_id = s.id
      WHERE filter_status = 'accepted')
"""


@query(f"""
    WITH {LISTS} SELECT id, region, name, phones, links, price, coalesce(price_type, 'not_checked') AS price_type, st AS price_status, external_id,
      'Найден и классифицирован' || CASE WHEN details_status = 'success' THEN '; Карточка 2ГИС проверена' ELSE '' END
      || CASE WHEN reached THEN '' WHEN details_status = 'success' THEN '; контакты и официальный сайт API не предоставил' ELSE '; контакты не проверены' END
      || CASE st WHEN 'not_checked' THEN '; цена не проверена' WHEN 'not_found' THEN '; цена не найдена' WHEN 'ambiguous' THEN '; цена требует ручной проверки'
           WHEN 'error' THEN '; ошибка проверки цены' ELSE '' END || '.' AS comment,
      strftime(CAST(replace(substr(first_seen_text, 1, 19), 'T', ' ') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS first_seen,
      strftime(greatest(coalesce(details_enriched_at, TIMESTAMP '1900-01-01'), CAST(last_seen_text AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S') AS last_checked
    FROM acc
""")
def accepted_export(spark, sf):
    report = R.accepted_report(
        _salons(spark, sf), view(spark, sf, "v_regions"), _contacts(spark, sf), view(spark, sf, "v_prices"))
    shown = "yyyy-MM-dd HH:mm:ss"
    return report.select(
        "id", "region", "name", F.array_join("phones", "|").alias("phones"), F.array_join("links", "|").alias("links"), "price", "price_type",
        "price_status", "external_id", "comment", F.date_format("first_seen_at", shown).alias("first_seen"),
        F.date_format("last_checked_at", shown).alias("last_checked"))


@query("""
    SELECT s.id, r.name AS region, s.name, rejection_reason, business_profile, external_id, classifier_version
    FROM v_salons s JOIN v_regions r ON r.id = s.region_id WHERE filter_status = 'rejected'
""")
def excluded_export(spark, sf):
    return R.excluded_report(_salons(spark, sf), view(spark, sf, "v_regions")).select(
        "id", "region", "name", "rejection_reason", "business_profile", "external_id", "classifier_version")


@query("""
    SELECT r.id, r.name AS region, CAST(count(*) FILTER (WHERE filter_status = 'accepted') AS BIGINT) AS accepted, CAST(count(*) FILTER (WHERE filter_status = 'rejected') AS BIGINT) AS rejected,
      CAST(count(*) FILTER (WHERE filter_status = 'accepted' AND s.id IN (SELECT salon_id FROM v_contacts WHERE is_active)) AS BIGINT) AS with_contacts,
      CAST(count(*) FILTER (WHERE filter_status = 'accepted' AND s.id IN (SELECT salon_id FROM v_prices WHERE is_active AND service_key = 'basic_manicure_with_coating'
        AND price_type IN ('exact', 'from', 'range'))) AS BIGINT) AS with_prices, r.status AS last_scan_status
    FROM v_regions r LEFT JOIN v_salons s ON s.region_id = r.id GROUP BY r.id, r.name, r.status
""")
def region_summary(spark, sf):
    v = lambda n: view(spark, sf, n)
    return R.region_summary(v("v_regions"), v("v_salons"), v("v_contacts"), v("v_prices")).drop("scan_order")


@query(f"""
    WITH {LISTS}, m AS (SELECT count(*) AS n, count(*) FILTER (WHERE phones <> '') AS ph, count(*) FILTER (WHERE links <> '') AS li,
        count(*) FILTER (WHERE price_type IN ('exact', 'from', 'range')) AS pr, count(*) FILTER (WHERE phones = '' AND links = '') AS none FROM acc)
    SELECT metric, value FROM (
      SELECT 'export_timestamp' AS metric, '2024-06-01' AS value UNION ALL SELECT 'database_path', 'store' UNION ALL SELECT 'current_classifier_version', 'v2'
      UNION ALL SELECT 'workbook_generation_status', 'complete' UNION ALL SELECT 'total_regions', CAST(count(*) AS VARCHAR) FROM v_regions
      UNION ALL SELECT 'regions_with_generated_grids', CAST(count(*) AS VARCHAR) FROM v_grids WHERE status = 'complete'
      UNION ALL SELECT 'rejected_salon_count', CAST(count(*) AS VARCHAR) FROM v_salons WHERE filter_status = 'rejected'
      UNION ALL SELECT 'accepted_salon_count', CAST(n AS VARCHAR) FROM m UNION ALL SELECT 'accepted_salons_with_phones', CAST(ph AS VARCHAR) FROM m
      UNION ALL SELECT 'accepted_salons_with_websites_socials', CAST(li AS VARCHAR) FROM m UNION ALL SELECT 'accepted_salons_with_active_target_price', CAST(pr AS VARCHAR) FROM m
      UNION ALL SELECT 'accepted_salons_without_contacts', CAST(none AS VARCHAR) FROM m UNION ALL SELECT 'accepted_salons_without_prices', CAST(n - pr AS VARCHAR) FROM m)
""")
def report_metrics(spark, sf):
    return R.export_datasets(
        _salons(spark, sf), view(spark, sf, "v_regions"), _contacts(spark, sf), view(spark, sf, "v_prices"), view(spark, sf, "v_grids"),
        "2024-06-01", "store", "v2")["report"]


@query("""
    WITH p AS (SELECT c_nationkey AS g, 179 + c_custkey % 20 / 10.0 - CASE WHEN 179 + c_custkey % 20 / 10.0 > 180 THEN 360 ELSE 0 END AS lon FROM customer),
    m AS (SELECT g, degrees(atan2(sum(sin(radians(lon))), sum(cos(radians(lon))))) AS mean_lon, max(lon) - min(lon) AS width FROM p GROUP BY g),
    u AS (SELECT g, max(x) - min(x) AS uw FROM (SELECT g, CASE WHEN lon - mean_lon > 180 THEN lon - 360 WHEN lon - mean_lon < -180 THEN lon + 360 ELSE lon END AS x FROM p JOIN m USING (g)) GROUP BY g)
    SELECT CAST(g AS BIGINT) AS region_id, round(mean_lon, 6) AS mean_lon, round(width, 6) AS width, round(uw, 6) AS unwrapped_width, width > 180 AND uw < width AS unwrap FROM m JOIN u USING (g)
""")
def longitude_wrap(spark, sf):
    raw = (179 + F.col("c_custkey") % 20 / 10.0).cast("double")
    points = table(spark, sf, "customer").select(F.col("c_nationkey").cast("bigint").alias("region_id"), geo.normalize_longitude(raw).alias("lon"))
    stats = longitude_stats(points)
    return stats.select("region_id", *[F.round(c, 6).alias(c) for c in ("mean_lon", "width", "unwrapped_width")], "unwrap")


def _boundaries(spark, sf):
    """Per supplier a slanted four-sided area with a four-sided hole."""
    k = F.col("s_suppkey").cast("double")
    lon, lat = F.lit(20.0) + F.pmod(k * 7.0, F.lit(300.0)), F.lit(-50.0) + F.pmod(k * 1.7, F.lit(110.0))
    w, h = F.lit(0.11) + F.pmod(k, F.lit(5.0)) * 0.013, F.lit(0.09) + F.pmod(k, F.lit(7.0)) * 0.011

    def ring(i, hole, corners):
        return F.struct(
            F.lit(i).alias("ring_id"), F.lit(hole).alias("is_hole"),
            F.array(*[F.struct((lon + w * x).alias("lon"), (lat + h * y).alias("lat")) for x, y in corners]).alias("points"))

    outer = ring(0, False, [(0.0, 0.0), (1.0, 0.1), (0.93, 1.0), (0.07, 0.87)])
    hole = ring(1, True, [(0.3, 0.3), (0.7, 0.33), (0.66, 0.7), (0.31, 0.64)])
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("region_id"), F.array(outer, hole).alias("rings"))


# The same cells by comparing every candidate cell with every edge and its centre with the rings.
GRID_SQL = """
    b AS (SELECT s_suppkey AS g, 20.0 + fmod(s_suppkey * 7.0, 300.0) AS lon, -50.0 + fmod(s_suppkey * 1.7, 110.0) AS lat,
        0.11 + fmod(s_suppkey, 5.0) * 0.013 AS w, 0.09 + fmod(s_suppkey, 7.0) * 0.011 AS h
        FROM (SELECT CAST(s_suppkey AS DOUBLE) AS s_suppkey FROM supplier)),
    v AS (SELECT g, r, i, n, CAST(lon + w * px AS DOUBLE) AS lon, CAST(lat + h * py AS DOUBLE) AS lat FROM b, (VALUES
        (0, 0, 4, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE)), (0, 1, 4, 1.0, 0.1), (0, 2, 4, 0.93, 1.0), (0, 3, 4, 0.07, 0.87),
        (1, 0, 4, 0.3, 0.3), (1, 1, 4, 0.7, 0.33), (1, 2, 4, 0.66, 0.7), (1, 3, 4, 0.31, 0.64)) t(r, i, n, px, py)),
    c AS (SELECT g, (min(lon) + max(lon)) / 2 AS lon0, (min(lat) + max(lat)) / 2 AS lat0 FROM v GROUP BY g),
    q AS (SELECT *, sin(radians(lat0)) * sin(radians(lat)) + cos(radians(lat0)) * cos(radians(lat)) * cos(radians(lon - lon0)) AS cc,
        sqrt(1 - 0.0066943799901413165 * pow(sin(radians(lat0)), 2)) AS rt FROM v JOIN c USING (g)),
    k AS (SELECT *, CASE WHEN sin(acos(least(greatest(cc, -1), 1))) < 1e-12 THEN 1 ELSE acos(least(greatest(cc, -1), 1)) / sin(acos(least(greatest(cc, -1), 1))) END AS k FROM q),
    p AS (SELECT g, r, i, n, 6378137.0 / rt * k * cos(radians(lat)) * sin(radians(lon - lon0)) AS x,
        6378137.0 * (1 - 0.0066943799901413165) / pow(rt, 3) * k * (cos(radians(lat0)) * sin(radians(lat)) - sin(radians(lat0)) * cos(radians(lat)) * cos(radians(lon - lon0))) AS y FROM k),
    f AS (SELECT g, min(x) AS mx, min(y) AS my, max(x) AS xx, max(y) AS xy, CAST(ceil((max(x) - min(x)) / 1500) AS INT) AS nc, CAST(ceil((max(y) - min(y)) / 1500) AS INT) AS nr FROM p GROUP BY g),
    e AS (SELECT a.g, a.x - mx AS x1, a.y - my AS y1, z.x - mx AS x2, z.y - my AS y2 FROM p a JOIN p z ON z.g = a.g AND z.r = a.r AND z.i = (a.i + 1) % a.n JOIN f ON f.g = a.g),
    cells AS (SELECT g, row, col, col * 1500.0 AS l, least((col + 1) * 1500.0, xx - mx) AS rr, row * 1500.0 AS s, least((row + 1) * 1500.0, xy - my) AS t
        FROM (SELECT *, unnest(range(0, nc)) AS col FROM (SELECT *, unnest(range(0, nr)) AS row FROM f))),
    m AS (SELECT cells.g, row, col,
        bool_or(greatest(y1, y2) >= s AND least(y1, y2) <= t AND CASE WHEN y1 = y2 THEN greatest(x1, x2) >= l AND least(x1, x2) <= rr ELSE
          greatest(x1 + (greatest(least(y1, y2), s) - y1) * (x2 - x1) / (y2 - y1), x1 + (least(greatest(y1, y2), t) - y1) * (x2 - x1) / (y2 - y1)) >= l
          AND least(x1 + (greatest(least(y1, y2), s) - y1) * (x2 - x1) / (y2 - y1), x1 + (least(greatest(y1, y2), t) - y1) * (x2 - x1) / (y2 - y1)) <= rr END) AS touched,
        count(*) FILTER (WHERE least(y1, y2) <= (s + t) / 2 AND (s + t) / 2 < greatest(y1, y2) AND x1 + ((s + t) / 2 - y1) * (x2 - x1) / (y2 - y1) < (l + rr) / 2) % 2 = 1 AS inside
      FROM cells JOIN e USING (g) GROUP BY ALL)
"""


@query(f"""
    WITH {GRID_SQL} SELECT CAST(g AS BIGINT) AS region_id, CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col, row_number() OVER (PARTITION BY g ORDER BY row, col) AS cell_order
    FROM m WHERE touched OR inside
""")
def grid_cell_rows(spark, sf):
    return grid_cells(_boundaries(spark, sf)).select("region_id", "row", "col", "cell_order")


@query(f"""
    WITH {GRID_SQL} SELECT CAST(g AS BIGINT) AS region_id, CAST(count(*) AS BIGINT) AS candidate_cells, CAST(count(*) FILTER (WHERE touched OR inside) AS BIGINT) AS accepted_cells FROM m GROUP BY 1
""")
def grid_cell_counts(spark, sf):
    boundaries = _boundaries(spark, sf)
    return grid_counts(boundaries, grid_cells(boundaries))


# Files of one landing, which are written by as many tasks.
LANDED_FILES = 4


def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")


def _as_response(events):
    item = F.struct(F.col("user_id").cast("string").alias("id"), F.concat(F.lit("Студия "), "event_type").alias("name"),
                    F.array(F.struct(F.when(F.col("event_id") % 2 == 0, "Маникюр").otherwise("Кафе").alias("name"))).alias("rubrics"))
    body = F.to_json(F.struct(F.struct(F.array(item).alias("items")).alias("result")))
    return events.select(
        F.col("event_id").alias("grid_cell_id"), F.lit(1).cast("bigint").alias("region_id"), F.lit("q").alias("query"), F.lit(1).alias("page"),
        F.lit("u").alias("source_url"), F.col("ts").cast("timestamp_ntz").alias("fetched_at"), body.alias("body"))


@query("""
    SELECT event_id AS cell, CAST(user_id AS VARCHAR) AS external_id, event_id % 2 = 0 AS accepted FROM events
""")
def stream_ingest(spark, sf):
    out, state = run_dir(spark, "ingest"), run_dir(spark, "ingest-state")
    flows.append_available(flows.decided_sightings(_as_response(_event_stream(spark, sf))), out, state).awaitTermination()
    return spark.read.parquet(out).select(F.col("discovered_grid_cell_id").alias("cell"), "external_id", "accepted")


def _landed_events(spark, sf):
    """Events landed in three writes of several files each, and read back a write a micro-batch."""
    events, landing = table(spark, sf, "events"), run_dir(spark, "landing")
    for part in range(3):
        events.filter(F.col("event_id") % 3 == part).repartition(LANDED_FILES).write.mode("append").parquet(landing)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", LANDED_FILES).parquet(landing)


LANDED = """
    seen AS (SELECT CAST(user_id AS VARCHAR) AS external_id, event_type, event_id,
        row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3, ts, event_id) AS nth,
        row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3 DESC, ts DESC, event_id DESC) AS back FROM events)
"""


def _stream_merged(spark, sf):
    """Three micro-batches merged into a table that knows every tenth user already; then the
    same stream started again, which must add nothing."""
    from placeledger import schemas
    from placeledger.operators.parse_search import parse_search
    from placeledger.sources.sinks import write_snapshot

    root, state, history = (run_dir(spark, name) for name in ("salons", "salons-state", "discoveries"))
    known = table(spark, sf, "events").select("user_id").distinct().filter("user_id % 10 = 0").select(
        F.col("user_id").alias("id"), F.lit("2GIS").alias("external_source"), F.col("user_id").cast("string").alias("external_id"),
        F.lit(1).cast("bigint").alias("region_id"), F.lit("known").alias("name"), F.lit("kept").alias("city"))
    empty = spark.createDataFrame([], schemas.SALON)
    write_snapshot(empty.unionByName(known, allowMissingColumns=True), root, "known")
    sightings, _ = parse_search(_as_response(spread(_landed_events(spark, sf))))
    for _ in range(2):
        flows.merge_available(sightings, root, state, as_of(), history=history).awaitTermination()
    return root, history


@query(f"""
    WITH {LANDED}
    SELECT external_id, event_type AS last_type, CASE WHEN event_id % 2 = 0 THEN 'accepted' ELSE 'rejected' END AS filter_status,
      CASE WHEN CAST(external_id AS BIGINT) % 10 = 0 THEN 'kept' END AS city
    FROM seen WHERE back = 1
""")
def stream_merge(spark, sf):
    from placeledger.sources.sinks import read_snapshot

    root, _ = _stream_merged(spark, sf)
    return read_snapshot(spark, root).select(
        "external_id", F.regexp_replace("name", "^Студия ", "").alias("last_type"), "filter_status", "city")


@query(f"""
    WITH {LANDED}
    SELECT external_id, event_id AS cell, event_id % 2 = 0 AS accepted, nth > 1 OR CAST(external_id AS BIGINT) % 10 = 0 AS merged FROM seen
""")
def stream_history(spark, sf):
    _, history = _stream_merged(spark, sf)
    return spark.read.parquet(history).select("external_id", F.col("discovered_grid_cell_id").alias("cell"), "accepted", "merged")


@query("SELECT DISTINCT user_id, event_type, props FROM events")
def stream_dedupe(spark, sf):
    out, state = run_dir(spark, "dedupe"), run_dir(spark, "dedupe-state")
    unique = flows.drop_repeats(_landed_events(spark, sf), ["user_id", "event_type", "props"], "ts", "60 days")
    flows.append_available(unique.select("user_id", "event_type", "props"), out, state).awaitTermination()
    return spark.read.parquet(out)


@query("""
    SELECT event_id AS run_id, CASE WHEN event_id % 2 = 0 AND ts + INTERVAL 30 MINUTE < TIMESTAMP '2024-01-20' THEN 'interrupted' WHEN event_id % 2 = 0 THEN 'running' ELSE 'complete' END AS status,
      CASE WHEN event_id % 2 = 0 AND ts + INTERVAL 30 MINUTE < TIMESTAMP '2024-01-20' THEN 'stale run recovered' END AS error_message FROM events
""")
def stale_runs(spark, sf):
    runs = table(spark, sf, "events").select(
        F.col("event_id").alias("run_id"), F.when(F.col("event_id") % 2 == 0, "running").otherwise("complete").alias("status"),
        F.col("ts").cast("timestamp_ntz").alias("started_at"), F.lit(None).cast("timestamp_ntz").alias("finished_at"),
        F.lit(None).cast("string").alias("error_message"))
    cutoff = F.lit(datetime(2024, 1, 20)).cast("timestamp_ntz")
    return flows.stale_runs(runs, cutoff, 30).select("run_id", "status", "error_message")


@query("""
    WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 240 MINUTE THEN 1 ELSE 0 END AS gap FROM events),
    s AS (SELECT *, sum(gap) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM g)
    SELECT user_id AS run_id, CAST(count(*) AS BIGINT) AS beats, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_beat, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_beat FROM s GROUP BY user_id, n
""")
def run_sessions(spark, sf):
    shown = "yyyy-MM-dd HH:mm:ss"
    sessions = flows.heartbeat_sessions(table(spark, sf, "events"), 240, run="user_id")
    return sessions.select(
        F.col("user_id").alias("run_id"), "beats", F.date_format("first_beat", shown).alias("first_beat"),
        F.date_format("last_beat", shown).alias("last_beat"))
