"""op7: blocks of vectors meet where they are read; nothing grows with their pairs."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from placeledger.llm import vectors as V


def clustered(rows, width, seed):
    """Vectors in groups; some of a group's pairs lie just over, some just under the cosine."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(rows // 10, width))
    near = np.repeat(centres, 10, axis=0) + rng.normal(scale=0.2, size=(rows // 10 * 10, width))
    return near.astype(np.float32)


def brute(found, cosine=0.95):
    unit = V.units(found.astype(float))
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    group = np.arange(len(found))
    while True:
        low = np.where(near, group[None, :], len(found)).min(axis=1)
        new = np.minimum(group, low)
        if np.array_equal(new, group):
            return Counter((k, int(near[k].sum()), int(group[k]), int(group[k]) == k) for k in range(len(found)))
        group = new


@pytest.mark.parametrize("kind", ["float", "double"])
def test_pairs_of_blocks_are_not_shuffled(spark, monkeypatch, kind):
    found = clustered(200, 12, 3)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(found)], f"vec_id long, embedding array<{kind}>")
    plans, written = {}, V.written

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name)

    monkeypatch.setattr(V, "written", kept)
    got = V.vector_components(table, rows_per_cell=40, chunk=15).collect()
    assert Counter(tuple(r) for r in got) == brute(found)
    assert "InArrow" in plans["vector-links"] and "Exchange" not in plans["vector-links"]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


def test_short_products_rule_out_no_link():
    # Cosines within the rounding of 32 bits around the limit.
    angles = np.arccos(0.95) + np.linspace(-3e-7, 3e-7, 41)
    unit = V.units(np.concatenate([[[1.0, 0.0]], np.stack([np.cos(angles), np.sin(angles)], axis=1)]))
    rows = np.arange(len(unit))
    _, linked = V.near_links(unit, unit.astype(np.float32), np.ones(len(unit)), rows[:1], rows[1:], 0.95)
    want = unit[1:] @ unit[0] >= 0.95
    assert 0 < want.sum() < 41 and linked[0] == want.sum() and (linked[1:] == want).all()


def test_far_blocks_leave_vectors_out_but_no_partner():
    found = clustered(400, 4, 8)
    unit = V.units(found.astype(float))
    pivots = {4: unit[:6]}
    radius = float(np.sqrt(2 - 2 * 0.95)) + 1e-5
    home = V.distances(unit, pivots[4]).argmin(axis=1)
    blocks = []
    for cell in range(6):
        own = np.flatnonzero(home == cell)
        away = V.distances(unit[own], pivots[4])
        blocks.append(V.Block({
            "width": 4, "cell": cell, "cls": own.astype(np.int64).tobytes(), "size": np.ones(len(own), np.int64).tobytes(),
            "v": found[own].tobytes(), "lows": away.min(axis=0), "highs": away.max(axis=0)}, pivots, np.float32))
    out = 0
    for one in blocks:
        for other in blocks:
            if one is not other:
                kept = one.near(other, radius)
                out += len(one.cls) - len(kept)
                linked = (one.unit @ other.unit.T >= 0.95).any(axis=1)
                assert set(np.flatnonzero(linked)) <= set(kept)
    assert out > 0


def test_links_of_many_tiles_are_folded():
    links, batches = V.Links(most=50), []
    for k in range(200):
        links.add(np.array([1, 2, 3 + k % 5]), np.array([0, 0, 1]), np.array([2.0, 1.0, 1.0]))
        batches += links.given()
    batches += [*links.given(last=True), *links.given(last=True)]
    rows = pa.Table.from_batches(batches).to_pylist()
    assert len(rows) < 60
    counts = Counter()
    for r in rows:
        if r["b"] is None:
            counts[r["a"]] += r["n"]
    assert counts == {1: 400, 2: 200, **{3 + k: 40 for k in range(5)}}
    assert {r["a"] for r in rows if r["b"] == 1} == {2, 3, 4, 5, 6, 7}
