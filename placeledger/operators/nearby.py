"""Points within a radius of centres."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from placeledger.fixed_values import EARTH_RADIUS_METERS
from placeledger.functions.geo import distance_m, unwrap_longitude

# Parts of a tile's points.
PARTS = 4
_DEGREE_M = EARTH_RADIUS_METERS * math.pi / 180


def _tile(lat: Column, lon: Column, metres: float) -> tuple[Column, Column]:
    """Row by latitude; column by longitude scaled at the row's end nearest a pole, so
    a column is never narrower than `metres` on the ground."""
    step = metres / _DEGREE_M
    row = F.floor(lat / step).cast("bigint")
    return row, _column(row, lon, step)


def _column(row: Column, lon: Column, step: float) -> Column:
    edge = F.greatest(F.abs(row * step), F.abs((row + 1) * step))
    shrink = F.greatest(F.cos(F.radians(F.least(edge, F.lit(89.9)))), F.lit(1e-3))
    return F.floor(lon * shrink / step).cast("bigint")


def _one_turn(lon: Column) -> Column:
    """Longitude from -180 up to, not including, 180."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def points_within(centres: DataFrame, points: DataFrame, radius_m: float, centre_id: str, point_id: str,
                  centre_at: tuple[str, str] = ("lat", "lon"), point_at: tuple[str, str] = ("lat", "lon")) -> DataFrame:
    """(centre id, point id, distance_m) of all pairs within the radius.

    Space is cut into tiles a little wider than the radius. A centre looks into its own
    and the eight adjacent tiles, so an equality join on the tile replaces comparing
    everything with everything. Centres are the smaller side by nature (one per scan
    cell); they go to each of the few parts that a tile's points are dealt to. What a task has to
    do is the pairs it meets, not the rows it reads, so the number of tasks is that of the
    session's shuffles and is not lowered for small inputs.
    Longitudes may be given in any turn; they are brought to one, and a centre whose circle
    crosses the 180th meridian looks in from the other side too.
    """
    width = radius_m * 1.01
    step = width / _DEGREE_M
    lat, lon = F.col(point_at[0]), _one_turn(F.col(point_at[1]))
    row, column = _tile(lat, lon, width)
    tiled = points.select(
        point_id, lat.alias("_plat"), lon.alias("_plon"), row.alias("_row"), column.alias("_col"),
        F.pmod(F.xxhash64(point_id), F.lit(PARTS)).alias("_part"))
    clat, clon = F.col(centre_at[0]), _one_turn(F.col(centre_at[1]))
    rows = centres.select(
        centre_id, clat.alias("_clat"), clon.alias("_clon"),
        F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(clat / step).cast("bigint") + d)).alias("_row"),
    )
    # Columns differ from row to row: take the ones the circle's ends fall into.
    reach = F.lit(width) / (
        _DEGREE_M * F.greatest(F.cos(F.radians(F.least(F.abs(F.col("_clat")) + step, F.lit(89.9)))), F.lit(1e-3))
    )
    # A circle over the edge of the map is looked for once more, a turn away, up to the edge.
    turns = F.filter(F.array(F.lit(0.0), F.lit(-360.0), F.lit(360.0)), lambda t: (
        (F.col("_clon") + t + reach >= -180) & (F.col("_clon") + t - reach <= 180)))

    def end(turn: Column, offset: Column) -> Column:
        at = F.least(F.greatest(F.col("_clon") + turn + offset, F.lit(-180.0)), F.lit(180.0))
        return _column(F.col("_row"), at, step)

    # Near a pole the turns meet in the same columns.
    columns = F.array_distinct(F.flatten(F.transform(turns, lambda t: F.sequence(end(t, -reach), end(t, reach)))))
    parts = F.sequence(F.lit(0).cast("bigint"), F.lit(PARTS - 1).cast("bigint"))
    looked = rows.select(centre_id, "_clat", "_clon", "_row", F.explode(columns).alias("_col")).withColumn("_part", F.explode(parts))
    place, tasks = ["_row", "_col", "_part"], int(centres.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = looked.repartition(tasks, *place).join(tiled.repartition(tasks, *place), place).withColumn(
        "distance_m", distance_m(F.col("_clat"), F.col("_clon"), F.col("_plat"), unwrap_longitude("_plon", "_clon"))
    )
    return pairs.filter(F.col("distance_m") <= radius_m).select(centre_id, point_id, "distance_m")
