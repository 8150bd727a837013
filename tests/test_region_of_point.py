"""Regions of points: numbers of lines beyond 64 bits, and edges that a tile leaves out or counts once."""

import math
import random

import pytest

from placeledger.operators.locate import regions_of_points

RING = "region_id long, rings array<struct<ring_id: int, is_hole: boolean, points: array<struct<lon: double, lat: double>>>>"


def number(o, p, s, n):
    return ((o * 1000000 + p) * 100000 + s) * 10 + n


def test_line_numbers_beyond_64_bits(spark, tmp_path):
    from workload.indexed import region_of_point

    found = {}
    # 29 orders further a line has the same place.
    for name, more in (("small", 0), ("large", 29 * 2_000_000)):
        sf = str(tmp_path / name)
        rows = [(k + more, 23 * 300_000 + k % 23, k % 40, k % 7 + 1) for k in range(400)]
        rows += [(None, 1, 2, 3), (5 + more, 1, None, 3)]
        spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(f"{sf}/lineitem.parquet")
        spark.createDataFrame([(s,) for s in range(40)], "s_suppkey long").write.parquet(f"{sf}/supplier.parquet")
        got = region_of_point(spark, sf)
        found[name] = sorted((int(r["point"]), r["region_id"]) for r in got.collect())
        kinds = {f.name: f.dataType.simpleString() for f in got.schema}
        assert kinds == {"point": "bigint" if not more else "decimal(38,0)", "region_id": "bigint"}
        assert {p for p, _ in found[name]} <= {number(*r) for r in rows if None not in r}
    assert len(found["small"]) > 100 and max(found["large"])[0] > 2 ** 63
    assert found["large"] == [(p + 29 * 2_000_000 * 10 ** 12, g) for p, g in found["small"]]


def star(rng, corners, x, y, wide):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    return [(x + wide * rng.uniform(0.4, 1) * math.cos(t), y + wide * rng.uniform(0.4, 1) * math.sin(t)) for t in turns]


def inside(rings, px, py):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if min(y1, y2) <= py < max(y1, y2) and x1 + (py - y1) * (x2 - x1) / (y2 - y1) > px:
                odd = not odd
    return odd


@pytest.mark.parametrize("corners,size", [(5, 0.05), (5, 0.4), (150, 0.3)])
def test_edges_left_out_or_counted_once(frame, corners, size):
    rng = random.Random(corners)
    regions = {g: [star(rng, corners, rng.uniform(0, 1), rng.uniform(0, 1), 0.8), [(0.2, 0.2), (0.4, 0.2), (0.4, 0.4), (0.2, 0.4)]] for g in range(6)}
    # On lines between tiles and on corners too.
    places = [(rng.uniform(-1, 2), rng.uniform(-1, 2)) for _ in range(600)]
    places += [(round(x * 20) / 20, round(y * 20) / 20) for x, y in places[:200]] + [p for r in regions.values() for p in r[0]]
    boundaries = frame([{"region_id": g, "rings": [(k, k > 0, ring) for k, ring in enumerate(rings)]} for g, rings in regions.items()], RING)
    points = frame([{"p": k, "lat": y, "lon": x} for k, (x, y) in enumerate(places)], "p long, lat double, lon double")
    found = regions_of_points(points, boundaries, "p", size=size)
    want = sorted((k, g) for k, (x, y) in enumerate(places) for g, rings in regions.items() if inside(rings, x, y))
    assert sorted(tuple(r) for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Few edges a tile are compared in generated code.
    assert ("lambda" in plan) == (corners == 150)
