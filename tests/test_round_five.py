"""What large inputs must not do to one task or to the driver."""

from __future__ import annotations

from placeledger.operators.identity import connected_components, match_existing

SIGHTING = ("seq long, region_id long, external_source string, external_id string, normalized_name string, "
            "normalized_address string, normalized_phone string, latitude double, longitude double")
SALON = SIGHTING.replace("seq", "id").replace("normalized_phone", "phone")


def test_hits_are_not_sorted_before_they_meet(spark):
    known = spark.createDataFrame([(7, 1, "s", "a", "n", None, "5", None, None), (3, 1, "s", "b", "n", None, "5", None, None)], SALON)
    seen = spark.createDataFrame(
        [(1, 1, "s", "a", "n", None, "5", None, None), (2, 1, "s", "z", "n", None, "5", None, None),
         (4, 1, None, None, None, None, None, None, None)], SIGHTING)
    best = match_existing(seen, known)
    assert sorted(map(tuple, best.collect())) == [(1, 7, 0), (2, 3, 2), (4, None, None)]
    # The rows of a sighting are dealt as they are: nothing is reduced on the other side of that exchange.
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [seq" in plan, plan


def test_rounds_of_components_send_no_side_through_the_driver(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 9)] + [(20, 21)], "a long, b long")
    found = connected_components(edges)
    assert {tuple(r) for r in found.collect()} == {(i, 1) for i in range(1, 10)} | {(20, 20), (21, 20)}
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
