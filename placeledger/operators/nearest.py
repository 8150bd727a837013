"""The k nearest points of many centres."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from placeledger.operators.nearby import points_within
from placeledger.session import cut_lineage

# Farther than any two places on Earth by the distance used here.
FARTHEST_M = 30_000_000.0


def nearest_points(
    centres: DataFrame, points: DataFrame, k: int, centre_id: str, point_id: str, first_m: float = 2_000.0,
    centre_at: tuple[str, str] = ("lat", "lon"), point_at: tuple[str, str] = ("lat", "lon"),
) -> DataFrame:
    """(centre id, place, point id, distance_m): places 1 to k, by distance and then by id.

    Circles grow: a centre that has k points within the radius has its nearest, for all others
    are farther; the rest look again in twice the radius. A round's tiles fit its radius, a
    centre leaves when it is served, and a centre's points are cut to k before they
    are shuffled on. Rounds are at most log2 of the Earth over the first radius. Fewer than k
    points in all give fewer rows; places without coordinates are in no result. Crowded tiles
    are split by adaptive skew handling.
    """
    here, there = centre_at, point_at
    placed = points.filter(F.col(there[0]).isNotNull() & F.col(there[1]).isNotNull()).select(point_id, *there)
    waiting = cut_lineage(centres.filter(F.col(here[0]).isNotNull() & F.col(here[1]).isNotNull()).select(centre_id, *here).distinct())
    by_distance = Window.partitionBy(centre_id).orderBy("distance_m", point_id)
    served, radius = [], first_m
    while not waiting.isEmpty():
        last = radius >= FARTHEST_M
        near = points_within(waiting, placed, min(radius, FARTHEST_M), centre_id, point_id, here, there)
        best = cut_lineage(near.withColumn("place", F.row_number().over(by_distance)).filter(F.col("place") <= k))
        full = best.filter((F.col("place") == k) | F.lit(last)).select(centre_id).distinct()
        served.append(best.join(full, centre_id, "left_semi"))
        if last:
            break
        waiting = cut_lineage(waiting.join(full, centre_id, "left_anti"))
        radius *= 2
    columns = [centre_id, "place", point_id, "distance_m"]
    if not served:
        return points_within(waiting, placed, first_m, centre_id, point_id, here, there).withColumn("place", F.lit(0)).select(*columns)
    out = served[0]
    for part in served[1:]:
        out = out.unionByName(part)
    return out.select(*columns)
