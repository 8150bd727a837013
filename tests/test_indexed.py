"""Bucketed state, the stored key index, ring assembly, nearest points and regions of points."""

import math

import pytest
from pyspark.sql import functions as F

from placeledger.operators.identity import resolve_batch
from placeledger.operators.identity_index import create_index, resolve_next, resolved
from placeledger.operators.locate import regions_of_points
from placeledger.operators.nearest import nearest_points
from placeledger.operators.rings import assemble_rings
from placeledger.session import run_dir
from placeledger.sources import buckets as B
from placeledger.sources.sinks import current_version, move_pointer, read_snapshot, write_snapshot


def newest(before, batch):
    both = before.withColumn("age", F.lit(0)).unionByName(batch.withColumn("age", F.lit(1)))
    return both.groupBy("k").agg(F.max_by("v", "age").alias("v"))


@pytest.fixture
def numbers(spark):
    root = run_dir(spark, "numbers")
    B.create_table(spark.range(200).select(F.col("id").alias("k"), F.lit("old").alias("v")), root, ["k"], 16)
    return root


def folders(spark, root, version=None):
    return {r["bucket"]: r["folder"] for r in B.manifest(spark, root, version).filter("bucket >= 0").collect()}


def test_a_batch_rewrites_only_its_buckets(spark, frame, numbers):
    before = folders(spark, numbers)
    batch = frame([{"k": 3, "v": "new"}, {"k": 1000, "v": "new"}, {"k": None, "v": "new"}], "k long, v string")
    assert B.merge_batch(batch, numbers, newest, "one") == 1
    after, touched = folders(spark, numbers), B.touched_buckets(batch, ["k"], 16)
    assert {b for b in after if after[b] != before.get(b)} == touched and len(touched) < 4
    rows = {r["k"]: r["v"] for r in B.read_table(spark, numbers).collect()}
    assert len(rows) == 202 and {k for k, v in rows.items() if v == "new"} == {3, 1000, None}
    # The older version is still there, and a replay changes nothing.
    assert B.read_table(spark, numbers, 0).filter("v = 'new'").count() == 0
    assert B.merge_batch(batch.withColumn("v", F.lit("again")), numbers, newest, "one") == 1
    assert B.stored_versions(spark, numbers) == [0, 1]


def test_versions_are_numbered_and_a_taken_number_fails(spark, frame, numbers):
    batch = frame([{"k": 3, "v": "new"}], "k long, v string")
    inside = []

    def meanwhile(before, rows):
        if not inside:
            inside.append(B.merge_batch(rows.withColumn("v", F.lit("other")), numbers, newest))
        return newest(before, rows)

    with pytest.raises(Exception, match="version=00000001|PATH_ALREADY_EXISTS"):
        B.merge_batch(batch, numbers, meanwhile)
    assert B.read_table(spark, numbers).filter("k = 3").first()["v"] == "other"


def test_expired_versions_leave_only_files_in_use(spark, frame, numbers):
    for k in (1, 2, 1):
        B.merge_batch(frame([{"k": k, "v": "new"}], "k long, v string"), numbers, newest)
    assert B.expire_versions(spark, numbers, 1) > 0 and B.stored_versions(spark, numbers) == [3]
    assert B.read_table(spark, numbers).filter("v = 'new'").count() == 2 and B.read_table(spark, numbers).count() == 200
    with pytest.raises(ValueError, match="does not touch"):
        B.merge_batch(frame([{"k": 1, "v": "x"}], "k long, v string"), numbers, lambda a, b: a.withColumn("k", F.col("k") + 1))


def test_empty_tables_and_emptied_buckets(spark, frame):
    root = run_dir(spark, "empty")
    B.create_table(spark.createDataFrame([], "k long, v string"), root, ["k"], 4)
    assert B.read_table(spark, root).collect() == []
    with pytest.raises(ValueError, match="no table"):
        B.read_table(spark, run_dir(spark, "nowhere"))
    B.merge_batch(frame([{"k": 1, "v": "x"}], "k long, v string"), root, newest)
    assert B.read_table(spark, root).count() == 1
    B.merge_batch(frame([{"k": 1, "v": "x"}], "k long, v string"), root, lambda a, b: a.filter("false"))
    assert B.read_table(spark, root).count() == 0


def test_pointers_are_numbered(spark):
    root = run_dir(spark, "pointers")
    write_snapshot(spark.range(1), root, "a")
    write_snapshot(spark.range(2), root, "b")
    # A pointer whose writer's clock runs ahead, from before pointers had numbers.
    late = spark.range(1).select(F.lit("a").alias("version"), F.expr("timestamp'2999-01-01'").alias("written_at"))
    late.write.mode("append").parquet(f"{root}/_pointers")
    assert current_version(spark, root) == "b" and read_snapshot(spark, root).count() == 2
    move_pointer(spark, root, "a")
    assert current_version(spark, root) == "a"


OBS = "seq long, region_id long, external_source string, external_id string, normalized_name string, normalized_address string, normalized_phone string, latitude double, longitude double"


def sighting(seq, name=None, address=None, phone=None, external=None):
    return {"seq": seq, "region_id": 1, "external_source": "s", "external_id": external, "normalized_name": name,
            "normalized_address": address, "normalized_phone": phone}


def test_a_bridge_joins_entities_of_earlier_batches(spark, frame):
    root = run_dir(spark, "bridges")
    create_index(spark, root, 4)
    batches = [
        [sighting(10, "a", "x"), sighting(11, "b", "y"), sighting(12)],
        [sighting(20, "c", "z", external="e1"), sighting(21, "a", "x", "1")],
        [sighting(30, "b", "y", external="e1"), sighting(31, "a", None, "1"), sighting(32, "c", "z"), sighting(33)],
        # A later batch with a smaller seq renames what it joins, also through an old name.
        [sighting(5, "b", "y"), sighting(40, "c", "z"), sighting(41, external="e1")],
    ]
    moved = [sorted(tuple(r) for r in resolve_next(frame(rows, OBS), root, str(k)).collect()) for k, rows in enumerate(batches)]
    assert moved == [[], [], [(20, 11)], [(11, 5)]]
    got = dict(tuple(r) for r in resolved(spark, root).collect())
    together = frame([r for rows in batches for r in rows], OBS)
    assert got == dict(tuple(r) for r in resolve_batch(together).collect())
    assert resolve_next(frame(batches[3], OBS), root, "3").collect() == []
    assert dict(tuple(r) for r in resolved(spark, root).collect()) == got
    assert resolve_next(frame([], OBS), root, "none").collect() == []


WAY = "boundary_id long, way_id long, role string, points array<struct<lon: double, lat: double>>"


def way(boundary, number, role, *points):
    return {"boundary_id": boundary, "way_id": number, "role": role, "points": [(float(x), float(y)) for x, y in points]}


def test_rings_from_pieces(frame):
    a, b, c, d = (0, 0), (1, 0), (1, 1), (0, 1)
    ways = [
        way(1, 7, "outer", c, b), way(1, 3, "", a, b), way(1, 9, None, a, d, c), way(1, 9, None, a, d, c),
        # Inner pieces with the same ends do not join outer ones; a closed piece is a ring.
        way(1, 4, "inner", a, b, c, a), way(1, 5, "outer", (9, 9)), way(1, 6, "outer", (5, 5), (6, 5), (5, 6), (5, 5)),
        # Two pieces make a ring; a chain stays open.
        way(2, 1, "outer", a, b, c), way(2, 2, "outer", a, c), way(3, 1, "outer", a, b), way(3, 2, "outer", c, b), way(4, 1, "outer", a, c),
    ]
    rings, chains = assemble_rings(frame(ways, WAY))
    got = {(r["boundary_id"], r["ring_id"], r["is_hole"]): (r["n_ways"], [tuple(map(int, p)) for p in r["points"]]) for r in rings.collect()}
    assert got == {
        (1, 3, False): (3, [a, b, c, d, a]), (1, 4, True): (1, [a, b, c, a]), (1, 6, False): (1, [(5, 5), (6, 5), (5, 6), (5, 5)]),
        (2, 1, False): (2, [a, b, c, a]),
    }
    assert sorted((r["boundary_id"], r["ways"]) for r in chains.collect()) == [(3, [1, 2]), (4, [1])]
    none = assemble_rings(frame([], WAY))
    assert none[0].collect() == [] and none[1].collect() == []


def test_rings_that_touch_and_a_long_one(frame):
    n = 150
    spots = [(math.cos(k * 2 * math.pi / n), math.sin(k * 2 * math.pi / n)) for k in range(n)]
    ways = [way(1, (k * 77) % n, "outer", *([spots[k], spots[(k + 1) % n]][::-1 if k % 3 else 1])) for k in range(n)]
    rings, chains = assemble_rings(frame(ways, WAY))
    row = rings.first()
    points = [tuple(p) for p in row["points"]]
    assert (rings.count(), row["n_ways"], len(points), points[0]) == (1, n, n + 1, points[-1]) and set(points) == set(spots)
    turns = {(spots.index(q) - spots.index(p)) % n for p, q in zip(points, points[1:])}
    assert turns in ({1}, {n - 1}) and chains.count() == 0
    # Four ends in one place are paired in the order of their ways.
    eight = [way(2, 1, "outer", (0, 0), (1, 0)), way(2, 2, "outer", (1, 0), (0, 0)), way(2, 3, "outer", (0, 0), (-1, 0)), way(2, 4, "outer", (-1, 0), (0, 0))]
    rings, chains = assemble_rings(frame(eight, WAY))
    assert sorted((r["ring_id"], r["n_ways"]) for r in rings.collect()) == [(1, 2), (3, 2)] and chains.count() == 0


def test_nearest_points_edges(frame):
    points = frame([
        {"id": 1, "lat": 0.0, "lon": 179.99}, {"id": 2, "lat": 0.0, "lon": -179.99}, {"id": 3, "lat": 0.0, "lon": -179.99},
        {"id": 4, "lat": 60.0, "lon": 10.0}, {"id": 5, "lat": None, "lon": 10.0}], "id long, lat double, lon double")
    centres = frame([{"c": 1, "lat": 0.0, "lon": -179.995}, {"c": 2, "lat": 61.0, "lon": 10.0}, {"c": 3, "lat": None, "lon": 1.0}], "c long, lat double, lon double")
    got = sorted((r["c"], r["place"], r["id"]) for r in nearest_points(centres, points, 2, "c", "id", first_m=100.0).collect())
    assert got[:3] == [(1, 1, 2), (1, 2, 3), (2, 1, 4)] and len(got) == 4
    assert nearest_points(centres, points, 9, "c", "id").count() == 8
    assert nearest_points(centres.filter("false"), points, 2, "c", "id").collect() == []
    assert nearest_points(centres, points.filter("false"), 2, "c", "id", first_m=1e6).collect() == []


RING = "region_id long, rings array<struct<ring_id: int, is_hole: boolean, points: array<struct<lon: double, lat: double>>>>"


@pytest.mark.parametrize("size", [0.03, 0.4, 5.0])
def test_points_in_regions(frame, size):
    def ring(k, hole, *corners):
        return (k, hole, [(float(x), float(y)) for x, y in corners])

    square = ring(0, False, (0, 0), (1, 0), (1, 1), (0, 1))
    regions = frame([
        {"region_id": 1, "rings": [square, ring(1, True, (0.4, 0.4), (0.4, 0.6), (0.6, 0.6), (0.6, 0.4))]},
        {"region_id": 2, "rings": [ring(0, False, (1, 0), (2, 0), (2, 1), (1, 1), (1, 0))]},
        {"region_id": 3, "rings": [ring(0, False, (179.5, 0), (-179.5, 0), (-179.5, 1), (179.5, 1))]},
    ], RING)
    points = frame([{"p": k, "lat": y, "lon": x} for k, (x, y) in enumerate([
        (0.2, 0.2), (0.5, 0.5), (1.0, 0.5), (1.5, 0.0), (1.5, 1.0), (179.9, 0.5), (-179.9, 0.5), (180.1, 0.5), (0.2, None), (50.0, 50.0), (0.0, 0.5), (361.5, 0.5),
    ])], "p long, lat double, lon double")
    got = sorted((r["p"], r["region_id"]) for r in regions_of_points(points, regions, "p", size=size).collect())
    assert got == [(0, 1), (2, 2), (3, 2), (5, 3), (6, 3), (7, 3), (10, 1), (11, 2)]
    assert regions_of_points(points, regions.filter("false"), "p", size=size).collect() == []


def test_history_prunes_replays_and_compacts(spark, tmp_path):
    from pyspark.sql import functions as F

    from placeledger.sources import history as H

    root = str(tmp_path / "history")
    schema = "id bigint, region bigint, day string, folder_note string"
    batch = lambda *rows: spark.createDataFrame(rows, schema)
    first = batch((1, 1, "2024-01-01", "a"), (2, None, "2024-01-01", "b"), (3, 2, None, "c"), (1, 1, "2024-01-01", "a"))
    assert H.append_history(first, root, ["region", "day"], "one")
    assert not H.append_history(first, root, ["region", "day"], "one")
    assert H.append_history(batch((4, 1, "2024-01-01", None), (5, None, "2024-01-01", "e")), root, ["region", "day"], "two")
    assert H.append_history(batch(), root, ["region", "day"], "none")

    def ids(where=None):
        return sorted(r["id"] for r in H.read_history(spark, root, where).collect())

    assert ids() == [1, 1, 2, 3, 4, 5] and ids(F.col("region") == 1) == [1, 1, 4]
    plan = H.read_history(spark, root, F.col("region") == 1)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    folders = lambda: {(r["region"], r["day"]): (r["folders"], r["n_rows"]) for r in H.folder_counts(spark, root).collect()}
    assert folders() == {(1, "2024-01-01"): (2, 3), (None, "2024-01-01"): (2, 2), (2, None): (1, 1)}
    assert H.compact_history(spark, root) == 2 and H.compact_history(spark, root) == 0
    assert folders() == {(1, "2024-01-01"): (1, 3), (None, "2024-01-01"): (1, 2), (2, None): (1, 1)}
    assert ids() == [1, 1, 2, 3, 4, 5]
    # A batch that was compacted away is still known by its name.
    assert not H.append_history(first, root, ["region", "day"], "two") and ids() == [1, 1, 2, 3, 4, 5]
    # Folders that no catalogue names do not count.
    H._write(first, root, ["region", "day"], "died")
    assert ids() == [1, 1, 2, 3, 4, 5]


def test_cell_life_in_a_stream(spark, tmp_path):
    """Out of order, repeated, late and useless events; an end that comes after the time-out;
    the state outlives a restart."""
    from datetime import datetime, timedelta

    from placeledger.streaming.cell_life import cell_changes, current_cells
    from placeledger.streaming.flows import append_available

    schema = "cell_id bigint, attempt int, event string, at timestamp"
    at = lambda minutes: datetime(2024, 1, 1) + timedelta(minutes=minutes)
    batches = [
        [(1, 1, "complete", at(5)), (1, 1, "running", at(0)), (1, 1, "running", at(0)), (2, 1, "running", at(0)),
         (3, 1, "running", at(1)), (3, 1, "failed", at(2)), (4, 2, "failed", at(9)), (4, 1, "running", at(3)),
         (None, 1, "running", at(1)), (9, None, "running", at(1)), (9, 1, None, at(1)), (9, 1, "odd", at(1)), (9, 1, "failed", None)],
        [(5, 1, "running", at(200)), (3, 2, "running", at(190)), (6, 2, "running", at(195))],
        [(2, 1, "complete", at(250)), (5, 1, "running", at(260)), (7, 1, "complete", at(4)), (8, 1, "running", at(400))],
    ]
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(schema).parquet(inbox)
        append_available(cell_changes(stream, 2, 60, "10 minutes"), out, state).awaitTermination()
    changes = spark.read.parquet(out)
    got = {r["cell_id"]: (r["status"], r["attempts"], r["interrupted"]) for r in current_cells(changes).collect()}
    assert got == {
        1: ("completed", 1, False), 2: ("completed", 1, False), 3: ("in_progress", 2, True), 4: ("failed", 2, False),
        5: ("pending", 1, True), 6: ("in_progress", 2, True), 8: ("in_progress", 1, False)}
    steps = [(r["change"], r["status"], r["interrupted"]) for r in changes.filter("cell_id = 2").orderBy("change").collect()]
    assert steps == [(1, "in_progress", False), (2, "pending", True), (3, "completed", False)]
