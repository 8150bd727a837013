"""Queries over stored state, key indexes and space."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeledger.fixed_values import EARTH_RADIUS_METERS
from placeledger.operators.grid import grid_cells
from placeledger.operators.identity_index import create_index, resolve_next, resolved
from placeledger.operators.locate import regions_of_points
from placeledger.operators.nearest import nearest_points
from placeledger.operators.rings import assemble_rings
from placeledger.session import cut_lineage, run_dir
from placeledger.sources import buckets as B, history as H
from placeledger.streaming import flows
from placeledger.streaming.cell_life import cell_changes, current_cells, numbered_attempts
from workload.entities import COMPONENTS, _linked_obs
from workload.registry import query
from workload.reports import GRID_SQL, _boundaries, _landed_events
from workload.views import table

E = F.expr


def _day_totals(orders):
    return orders.select(
        F.col("o_custkey").alias("customer"), F.lit(1).cast("bigint").alias("n_orders"), F.col("o_orderkey").alias("last_order"),
        E("cast(round(o_totalprice * 100) as bigint)").alias("cents"), F.col("o_orderstatus").alias("last_status"))


def _summed(before, batch):
    return before.unionByName(batch).groupBy("customer").agg(
        F.sum("n_orders").alias("n_orders"), F.max("last_order").alias("last_order"), F.sum("cents").alias("cents"),
        F.max_by("last_status", "last_order").alias("last_status"))


def _totals_by_day(spark, sf):
    """Totals a customer of all but the last three days, and then those days, one batch each."""
    orders, root = table(spark, sf, "orders"), run_dir(spark, "totals")
    days = [r[0] for r in orders.select("o_orderdate").distinct().orderBy(F.desc("o_orderdate")).limit(3).collect()][::-1]
    past = _day_totals(orders.filter(F.col("o_orderdate") < days[0]))
    B.create_table(_summed(past.limit(0), past), root, ["customer"])
    for day in days:
        B.merge_batch(_day_totals(orders.filter(F.col("o_orderdate") == day)), root, _summed, name=str(day))
    return root, orders, days


@query("""
    SELECT o_custkey AS customer, CAST(count(*) AS BIGINT) AS n_orders, max(o_orderkey) AS last_order,
      CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, arg_max(o_orderstatus, o_orderkey) AS last_status
    FROM orders GROUP BY o_custkey
""")
def state_in_buckets(spark, sf):
    return B.read_table(spark, _totals_by_day(spark, sf)[0])


@query("""
    SELECT row_number() OVER (ORDER BY o_orderdate) AS batch, CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers,
      true AS others_kept, true AS own_rewritten
    FROM orders WHERE o_orderdate IN (SELECT DISTINCT o_orderdate FROM orders ORDER BY 1 DESC LIMIT 3) GROUP BY o_orderdate
""")
def state_kept_buckets(spark, sf):
    """From the manifests: what each batch's version holds of the version before it."""
    root, orders, days = _totals_by_day(spark, sf)
    out = []
    for k, day in enumerate(days):
        held = [B.manifest(spark, root, v).filter("bucket >= 0").select("bucket", F.col("folder").alias(f"folder{v - k}")) for v in (k, k + 1)]
        touched = orders.filter(F.col("o_orderdate") == day).select(B.bucket_of(["o_custkey"], 64).alias("bucket"))
        own = touched.distinct().withColumn("own", F.lit(True))
        both = held[0].join(held[1], "bucket", "full").join(own, "bucket", "left")
        same, mine = F.col("folder0").eqNullSafe(F.col("folder1")), F.coalesce("own", F.lit(False))
        counted = orders.filter(F.col("o_orderdate") == day).agg(F.count_distinct("o_custkey").alias("customers"))
        out.append(both.agg(
            F.bool_and(same | mine).alias("others_kept"), F.bool_and(~same | ~mine).alias("own_rewritten"),
        ).withColumn("batch", F.lit(k + 1).cast("bigint")).join(F.broadcast(counted)))
    return out[0].unionByName(out[1]).unionByName(out[2]).select("batch", "customers", "others_kept", "own_rewritten")


@query("""
    SELECT user_id, CAST(count(*) AS BIGINT) AS events, max(event_id) AS last_event FROM events GROUP BY user_id
""")
def stream_state(spark, sf):
    """Three micro-batches into a bucketed table, and the stream started again, which adds nothing."""
    root, state = run_dir(spark, "user-state"), run_dir(spark, "user-state-stream")
    rows = _landed_events(spark, sf).select("user_id", F.lit(1).cast("bigint").alias("events"), F.col("event_id").alias("last_event"))
    B.create_table(spark.createDataFrame([], "user_id bigint, events bigint, last_event bigint"), root, ["user_id"], 16)

    def merge(before, batch):
        return before.unionByName(batch).groupBy("user_id").agg(F.sum("events").alias("events"), F.max("last_event").alias("last_event"))

    for _ in range(2):
        flows.merge_touched(rows, root, state, merge).awaitTermination()
    return B.read_table(spark, root)


@query(COMPONENTS)
def identity_in_batches(spark, sf):
    """Four batches against a stored index give the components of one batch of everything."""
    root, obs = run_dir(spark, "identity"), _linked_obs(spark, sf)
    create_index(spark, root)
    for part in range(4):
        resolve_next(obs.filter(F.col("seq") % 4 == part), root, f"part-{part}")
    return resolved(spark, root)


def _ways(spark, sf):
    """Per supplier a ring of 24 points in six pieces, in shuffled order, some of them reversed;
    one in seven misses a piece, one in three has a hole in one piece."""
    s = F.col("s_suppkey")

    def point(i):
        return F.struct((s + i * (24 - i) / 1000.0).cast("double").alias("lon"), (s / 10.0 + i / 100.0).cast("double").alias("lat"))

    def corner(x, y):
        return F.struct((s + x).cast("double").alias("lon"), (s / 10.0 + y).cast("double").alias("lat"))

    pieces = table(spark, sf, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k"))
    along = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda j: point((F.col("k") * 4 + j) % 24))
    outer = pieces.filter("NOT (s_suppkey % 7 = 3 AND k = (s_suppkey % 6 + 3) % 6)").select(
        s.alias("boundary_id"), (s * 10 + (F.col("k") * 5 + s) % 6).alias("way_id"), F.lit("outer").alias("role"),
        F.when(E("(k + s_suppkey div 2) % 2 = 0"), F.reverse(along)).otherwise(along).alias("points"))
    hole = table(spark, sf, "supplier").filter("s_suppkey % 3 = 0").select(
        s.alias("boundary_id"), (s * 10 + 7).alias("way_id"), F.lit("inner").alias("role"),
        F.array(corner(0.05, 0.05), corner(0.06, 0.05), corner(0.06, 0.06), corner(0.05, 0.05)).alias("points"))
    return outer.unionByName(hole)


@query("""
    WITH b AS (SELECT s_suppkey AS s, s_suppkey % 6 AS k, (s_suppkey % 6 + s_suppkey // 2) % 2 = 0 AS back FROM supplier WHERE s_suppkey % 7 <> 3),
    p AS (SELECT *, CASE WHEN back THEN ((4 * k + 4 - (place - 1)) % 24 + 24) % 24 ELSE (4 * k + place - 1) % 24 END AS i
      FROM (SELECT *, unnest(range(1, 26)) AS place FROM b))
    SELECT s AS boundary_id, s * 10 AS ring_id, false AS is_hole, CAST(6 AS BIGINT) AS n_ways, place,
      round(s + i * (24 - i) / 1000.0, 6) AS lon, round(s / 10.0 + i / 100.0, 6) AS lat FROM p
    UNION ALL
    SELECT s_suppkey, s_suppkey * 10 + 7, true, 1, place, round(s_suppkey + x, 6), round(s_suppkey / 10.0 + y, 6)
    FROM supplier, (VALUES (1, 0.05, 0.05), (2, 0.06, 0.05), (3, 0.06, 0.06), (4, 0.05, 0.05)) t(place, x, y) WHERE s_suppkey % 3 = 0
""")
def rings_from_ways(spark, sf):
    rings, _ = assemble_rings(_ways(spark, sf))
    return rings.select("boundary_id", "ring_id", "is_hole", "n_ways", F.posexplode("points").alias("at", "p")).select(
        "boundary_id", "ring_id", "is_hole", "n_ways", (F.col("at") + 1).cast("bigint").alias("place"),
        F.round("p.lon", 6).alias("lon"), F.round("p.lat", 6).alias("lat"))


@query("""
    SELECT s_suppkey AS boundary_id, false AS is_hole, string_agg(CAST(s_suppkey * 10 + (k * 5 + s_suppkey) % 6 AS VARCHAR), ',' ORDER BY (k * 5 + s_suppkey) % 6) AS ways
    FROM (SELECT s_suppkey, unnest(range(0, 6)) AS k FROM supplier WHERE s_suppkey % 7 = 3) WHERE k <> (s_suppkey % 6 + 3) % 6 GROUP BY s_suppkey
""")
def open_ring_chains(spark, sf):
    _, chains = assemble_rings(_ways(spark, sf))
    return chains.select("boundary_id", "is_hole", F.array_join(F.transform("ways", lambda w: w.cast("string")), ",").alias("ways"))


@query(f"""
    WITH c AS (SELECT s_suppkey AS centre, -60 + fmod(s_suppkey * 1.37, 120) AS lat, CASE WHEN x >= 180 THEN x - 360 ELSE x END AS lon
        FROM (SELECT CAST(s_suppkey AS DOUBLE) AS s_suppkey, 170 + fmod(CAST(s_suppkey AS DOUBLE) * 7.3, 20) AS x FROM supplier)),
    p AS (SELECT c_custkey AS id, -60 + (c_custkey * 37 % 1009) / CAST(8.4 AS DOUBLE) AS lat, CASE WHEN x >= 180 THEN x - 360 ELSE x END AS lon
        FROM (SELECT c_custkey, 165 + (c_custkey * 61 % 997) / CAST(33.2 AS DOUBLE) AS x FROM customer)),
    d AS (SELECT centre, id, c.lat AS a, p.lat AS b, CASE WHEN p.lon - c.lon > 180 THEN p.lon - 360 WHEN p.lon - c.lon < -180 THEN p.lon + 360 ELSE p.lon END - c.lon AS g FROM c, p),
    m AS (SELECT centre, id, sqrt(pow(radians(b - a) * {EARTH_RADIUS_METERS}, 2) + pow(radians(g) * {EARTH_RADIUS_METERS} * cos(radians((a + b) / 2)), 2)) AS m FROM d)
    SELECT CAST(centre AS BIGINT) AS centre, CAST(place AS BIGINT) AS place, id, CAST(round(m) AS BIGINT) AS metres
    FROM (SELECT *, row_number() OVER (PARTITION BY centre ORDER BY m, id) AS place FROM m) WHERE place <= 3
""")
def nearest_three(spark, sf):
    """The three customers nearest to each supplier, on both sides of the 180th meridian."""
    s, c = F.col("s_suppkey").cast("double"), F.col("c_custkey")
    turn = lambda x: F.when(x >= 180, x - 360).otherwise(x)
    centres = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("centre"), (-60 + s * 1.37 % 120).alias("lat"), turn(170 + s * 7.3 % 20).alias("lon"))
    points = table(spark, sf, "customer").select(
        c.alias("id"), (-60 + (c * 37 % 1009) / 8.4).alias("lat"), turn(165 + (c * 61 % 997) / 33.2).alias("lon"))
    found = nearest_points(centres, points, 3, "centre", "id", first_m=20_000.0)
    return found.select("centre", F.col("place").cast("bigint").alias("place"), "id", F.round("distance_m").cast("bigint").alias("metres"))


def _line_number(lines):
    """The line's four keys as one number: of 64 bits if that holds it for every line, else a decimal."""
    keys = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    tried = E("try_add(try_multiply(try_add(try_multiply(try_add(try_multiply(l_orderkey, 1000000), l_partkey), 100000), l_suppkey), 10), l_linenumber)")
    beyond = lines.dropna(subset=keys).filter(tried.isNull()).limit(1).count()
    if not beyond:
        return E("((l_orderkey * 1000000 + l_partkey) * 100000 + l_suppkey) * 10 + l_linenumber")
    order, part, supplier, line = (F.col(k).cast("decimal(20,0)") for k in keys)
    wide = lambda x: x.cast("decimal(38,0)")
    return wide(wide(order * F.lit(10 ** 12).cast("decimal(13,0)")) + part * 10 ** 6 + supplier * 10 + line)


@query("""
    WITH b AS (SELECT s_suppkey AS g, 20.0 + fmod(s_suppkey * 7.0, 300.0) AS lon, -50.0 + fmod(s_suppkey * 1.7, 110.0) AS lat,
        0.11 + fmod(s_suppkey, 5.0) * 0.013 AS w, 0.09 + fmod(s_suppkey, 7.0) * 0.011 AS h
        FROM (SELECT CAST(s_suppkey AS DOUBLE) AS s_suppkey FROM supplier)),
    v AS (SELECT g, r, i, CAST(lon + w * px AS DOUBLE) AS x, CAST(lat + h * py AS DOUBLE) AS y FROM b, (VALUES
        (0, 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE)), (0, 1, 1.0, 0.1), (0, 2, 0.93, 1.0), (0, 3, 0.07, 0.87),
        (1, 0, 0.3, 0.3), (1, 1, 0.7, 0.33), (1, 2, 0.66, 0.7), (1, 3, 0.31, 0.64)) t(r, i, px, py)),
    u AS (SELECT *, CASE WHEN x - f > 180 THEN x - 360 * ceil((x - f - 180) / 360) WHEN x - f < -180 THEN x + 360 * ceil((f - x - 180) / 360) ELSE x END AS ux
        FROM (SELECT *, first_value(x) OVER (PARTITION BY g ORDER BY r, i) AS f FROM v)),
    e AS (SELECT a.g, a.ux AS x1, a.y AS y1, z.ux AS x2, z.y AS y2 FROM u a JOIN u z ON z.g = a.g AND z.r = a.r AND z.i = (a.i + 1) % 4),
    n AS (SELECT g, min(x1) AS west, max(x1) AS east, min(y1) AS south, max(y1) AS north FROM e GROUP BY g),
    p AS (SELECT ((l_orderkey * 1000000 + l_partkey) * 100000 + l_suppkey) * 10 + l_linenumber AS point,
        b.lon + b.w * ((l_partkey % 23) / CAST(20.0 AS DOUBLE) - 0.05) AS px, b.lat + b.h * ((l_orderkey % 29) / CAST(25.0 AS DOUBLE) - 0.08) AS py
        FROM lineitem JOIN b ON b.g = l_suppkey),
    t AS (SELECT point, py, CASE WHEN px >= 180 THEN px - 360 ELSE px END + k AS px FROM p, (VALUES (0), (-360), (360)) o(k))
    SELECT point, CAST(g AS BIGINT) AS region_id FROM t JOIN n ON px BETWEEN west AND east AND py BETWEEN south AND north JOIN e USING (g)
    WHERE least(y1, y2) <= py AND py < greatest(y1, y2) AND x1 + (py - y1) * (x2 - x1) / (y2 - y1) > px
    GROUP BY point, g, px HAVING count(*) % 2 = 1
""")
def region_of_point(spark, sf):
    """Every line's place, in or around its supplier's area, against the areas of all suppliers.

    A line's number is a bigint, as in the SQL, where all of them fit one. From about 9.2 million
    orders on they do not: the SQL has no answer then, and numbers are decimals, whole and exact.
    """
    k = F.col("l_suppkey").cast("double")
    lon, lat = F.lit(20.0) + F.pmod(k * 7.0, F.lit(300.0)), F.lit(-50.0) + F.pmod(k * 1.7, F.lit(110.0))
    w, h = F.lit(0.11) + F.pmod(k, F.lit(5.0)) * 0.013, F.lit(0.09) + F.pmod(k, F.lit(7.0)) * 0.011
    x, y = lon + w * (F.col("l_partkey") % 23 / 20.0 - 0.05), lat + h * (F.col("l_orderkey") % 29 / 25.0 - 0.08)
    lines = table(spark, sf, "lineitem")
    points = lines.select(
        _line_number(lines).alias("point"),
        F.when(x >= 180, x - 360).otherwise(x).alias("lon"), y.alias("lat"))
    return regions_of_points(points, _boundaries(spark, sf), "point")


@query(f"""
    WITH {GRID_SQL},
    placed AS (SELECT m.g, row, col, lat0, lon0, mx + col * 1500.0 AS x0, least(mx + (col + 1) * 1500.0, xx) AS x1,
        my + row * 1500.0 AS y0, least(my + (row + 1) * 1500.0, xy) AS y1, sqrt(1 - 0.0066943799901413165 * pow(sin(radians(lat0)), 2)) AS rt
        FROM m JOIN f ON f.g = m.g JOIN c ON c.g = m.g WHERE touched OR inside),
    corners AS (SELECT *, px / (6378137.0 / rt) AS a, py / (6378137.0 * (1 - 0.0066943799901413165) / pow(rt, 3)) AS b
        FROM (SELECT *, unnest([x0, x0, x1, x1, (x0 + x1) / 2]) AS px, unnest([y0, y1, y0, y1, (y0 + y1) / 2]) AS py, unnest([0, 1, 2, 3, 4]) AS n FROM placed)),
    turned AS (SELECT *, sqrt(a * a + b * b) AS cc, CASE WHEN sqrt(a * a + b * b) < 1e-15 THEN 1 ELSE sin(sqrt(a * a + b * b)) / sqrt(a * a + b * b) END AS s FROM corners),
    degs AS (SELECT *, degrees(asin(cos(cc) * sin(radians(lat0)) + b * s * cos(radians(lat0)))) AS lat,
        lon0 + degrees(atan2(a * s, cos(radians(lat0)) * cos(cc) - b * s * sin(radians(lat0)))) AS lon FROM turned),
    cell AS (SELECT g, row, col, max(lat) FILTER (WHERE n < 4) AS north, min(lat) FILTER (WHERE n < 4) AS south, min(lon) FILTER (WHERE n < 4) AS west,
        max(lon) FILTER (WHERE n < 4) AS east, max(lat) FILTER (WHERE n = 4) AS center_lat, max(lon) FILTER (WHERE n = 4) AS center_lon FROM degs GROUP BY g, row, col)
    SELECT CAST(g AS BIGINT) AS region_id, row_number() OVER (PARTITION BY g ORDER BY row, col) AS cell_order,
      round(north, 5) AS north, round(south, 5) AS south, round(CASE WHEN west > 180 THEN west - 360 ELSE west END, 5) AS west,
      round(CASE WHEN east > 180 THEN east - 360 ELSE east END, 5) AS east, round(center_lat, 5) AS center_lat,
      round(CASE WHEN center_lon > 180 THEN center_lon - 360 ELSE center_lon END, 5) AS center_lon FROM cell
""")
def grid_cell_corners(spark, sf):
    """Every cell's corners and centre in degrees."""
    places = ("north", "south", "west", "east", "center_lat", "center_lon")
    return grid_cells(_boundaries(spark, sf)).select("region_id", "cell_order", *[F.round(c, 5).alias(c) for c in places])


def _landed_history(spark, sf):
    """Orders by region and year, landed in three batches; the first comes twice. Partitions
    that more than one batch wrote to are compacted after the second."""
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("region_id"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    landed = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("o_orderkey").alias("id"), "o_totalprice", "region_id", F.year("o_orderdate").alias("year"))
    root = run_dir(spark, "history")
    for n, part in enumerate(("id % 3 = 0", "id % 3 = 1 AND region_id > 1", "id % 3 = 2 OR id % 3 = 1 AND NOT region_id > 1")):
        for _ in range(2 if n == 0 else 1):
            H.append_history(landed.filter(part), root, ["region_id", "year"], f"batch{n}")
        if n == 1:
            H.compact_history(spark, root)
    return root


HISTORY = """
    SELECT o_orderkey AS id, o_totalprice, n_regionkey AS region_id, year(o_orderdate) AS year
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
"""


@query(f"SELECT id, o_totalprice, CAST(region_id AS BIGINT) AS region_id, CAST(year AS INT) AS year FROM ({HISTORY}) WHERE region_id = 2")
def history_of_one_region(spark, sf):
    rows = H.read_history(spark, _landed_history(spark, sf), F.col("region_id") == 2)
    return rows.withColumn("region_id", F.col("region_id").cast("bigint"))


@query(f"""
    SELECT CAST(region_id AS BIGINT) AS region_id, CAST(year AS INT) AS year, CAST(count(*) AS BIGINT) AS n_rows,
      CAST(1 + max(CASE WHEN id % 3 = 2 OR NOT region_id > 1 AND id % 3 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS folders
    FROM ({HISTORY}) GROUP BY ALL
""")
def history_folders(spark, sf):
    """What is live after three batches and a compaction: at most two folders a partition."""
    counts = H.folder_counts(spark, _landed_history(spark, sf))
    return counts.withColumn("region_id", F.col("region_id").cast("bigint"))


RETRIES, STALE_DAYS = 11, 200


@query(f"""
    WITH a AS (SELECT o_custkey AS cell_id, o_orderstatus AS s, CAST(o_orderdate AS TIMESTAMP) AS began,
        count(*) OVER (PARTITION BY o_custkey) AS n, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS back FROM orders),
    w AS (SELECT max(began + CASE s WHEN 'P' THEN INTERVAL 0 HOUR ELSE INTERVAL 1 HOUR END) - INTERVAL 1 DAY AS mark FROM a),
    l AS (SELECT *, s = 'P' AND began + INTERVAL {STALE_DAYS} DAY < mark AS stale FROM a, w WHERE back = 1)
    SELECT cell_id, CASE WHEN s = 'O' THEN 'completed' WHEN s = 'F' THEN CASE WHEN n < {RETRIES} THEN 'pending' ELSE 'failed' END
        WHEN stale AND n < {RETRIES} THEN 'pending' ELSE 'in_progress' END AS status, CAST(n AS BIGINT) AS attempts, stale AS interrupted FROM l
""")
def stream_cells(spark, sf):
    """Orders as attempts on their customers as cells, landed in three spans of time, each twice;
    the stream is started again, which adds nothing."""
    orders = table(spark, sf, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    attempts = numbered_attempts(orders.select(
        F.col("o_custkey").alias("cell_id"), F.struct("o_orderdate", "o_orderkey").alias("id"), "at", "o_orderstatus"))
    ended = F.when(F.col("o_orderstatus") == "O", "complete").when(F.col("o_orderstatus") == "F", "failed")
    happened = F.filter(F.array(
        F.struct(F.lit("running").alias("event"), F.col("at").alias("at")),
        F.struct(ended.alias("event"), (F.col("at") + E("INTERVAL 1 HOUR")).alias("at"))), lambda e: e["event"].isNotNull())
    rows = cut_lineage(attempts.select("cell_id", "attempt", F.inline(happened)))
    files = max(4, spark.sparkContext.defaultParallelism)
    landing, out, state = (run_dir(spark, name) for name in ("attempts", "cell-changes", "cell-changes-state"))
    first, last = orders.agg(F.min("at"), F.max("at")).first()
    cuts = [first, first + (last - first) / 3, first + (last - first) * 2 / 3, None]
    for start, end in zip(cuts, cuts[1:]):
        span = rows.filter(F.col("at") >= start) if end is None else rows.filter((F.col("at") >= start) & (F.col("at") < end))
        span.unionByName(span).repartition(files).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(landing)
    for _ in range(2):
        flows.append_available(cell_changes(stream, RETRIES, STALE_DAYS * 24 * 60), out, state).awaitTermination()
    return current_cells(spark.read.parquet(out)).drop("at")
