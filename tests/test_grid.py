"""Boundaries to cells: holes, islands, high latitude, the 180th meridian."""

from placeledger import schemas
from placeledger.operators.grid import grid_cells


def box(w, s, e, n, i=0, hole=False):
    return {"ring_id": i, "is_hole": hole, "points": [{"lon": x, "lat": y} for x, y in ((w, s), (e, s), (e, n), (w, n), (w, s))]}


def test_shapes(spark, frame):
    shapes = {
        1: [box(30, 50, 30.1, 50.1)],
        2: [box(30, 50, 30.1, 50.1), box(30.03, 50.03, 30.07, 50.07, 1, True)],
        3: [box(30, 50, 30.03, 50.03), box(31, 50, 31.03, 50.03, 1)],
        4: [box(179.9, 60, 180, 60.05), box(-180, 60, -179.9, 60.05, 1)],
        5: [box(100, 75, 100.2, 75.05)],
    }
    rows = [{"region_id": k, "rings": [(r["ring_id"], r["is_hole"], [(float(p["lon"]), float(p["lat"])) for p in r["points"]]) for r in v]} for k, v in shapes.items()]
    got = {}
    for r in grid_cells(frame(rows, schemas.BOUNDARY)).collect():
        got.setdefault(r["region_id"], []).append(r)
    for cells in got.values():
        assert sorted(c["cell_order"] for c in cells) == list(range(1, len(cells) + 1))
        in_order = sorted(cells, key=lambda c: c["cell_order"])
        assert [(c["row"], c["col"]) for c in in_order] == sorted((c["row"], c["col"]) for c in cells)
    assert 0 < len(got[2]) < len(got[1])
    lons = [c["center_lon"] for c in got[3]]
    assert min(lons) < 30.5 < max(lons) and not any(30.1 < x < 30.9 for x in lons)
    assert all(-180 <= c["center_lon"] <= 180 for c in got[4]) and len(got[4]) < 100
    assert {c["center_lon"] > 0 for c in got[4]} == {True, False}
    assert all(74.9 < c["center_lat"] < 75.2 for c in got[5])
