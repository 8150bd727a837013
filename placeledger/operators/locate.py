"""Which regions a point lies in.

Space is cut into square tiles of degrees. A tile that a region's outline does not touch lies
inside it as a whole or not at all, so a point there needs no geometry. Only points in tiles of
the outline are compared with edges, those of the region that pass their row of tiles and do not
lie wholly to the west of the tile. Edges wholly to its east that pass the row from end to end cross
alike for all points of the tile and are counted once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from placeledger.functions.geo import unwrap_longitude
from placeledger.session import cut_lineage

TILE_DEGREES = 0.05
# Edges of a tile that are compared in generated code; further ones by a function over the list.
UNROLLED = 6
# By this much of a degree an edge must miss a tile before it is left out there.
_MARGIN = 1e-6


def _edges(boundaries: DataFrame, by: str) -> DataFrame:
    """(region, x1, y1, x2, y2) of all rings, closed. Longitudes are brought to within half a turn
    of the region's first point, so an outline over the 180th meridian is in one piece."""
    given = boundaries.select(by, F.col("rings")[0]["points"][0]["lon"].alias("_from"), F.explode("rings").alias("ring"))
    points = F.transform(F.col("ring.points"), lambda p: F.struct(
        unwrap_longitude(p["lon"].cast("double"), F.col("_from")).alias("x"), p["lat"].cast("double").alias("y")))
    rings = given.select(by, points.alias("points"))
    following = F.concat(F.slice("points", F.lit(2), F.size("points")), F.slice("points", 1, 1))
    pairs = rings.select(by, F.explode(F.arrays_zip(F.col("points").alias("a"), following.alias("b"))).alias("e"))
    ends = pairs.select(by, *[F.col(f"e.{end}.{axis}").alias(f"{axis}{n}") for n, end in (("1", "a"), ("2", "b")) for axis in "xy"])
    return ends.filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def _steps(low: Column, high: Column, size: float) -> Column:
    """Numbers of the steps that the closed interval meets; a value on a line between two is in both."""
    return F.sequence((F.ceil(low / size) - 1).cast("bigint"), F.floor(high / size).cast("bigint"))


def _x_at(y: Column) -> Column:
    return F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))


def tile_index(boundaries: DataFrame, size: float = TILE_DEGREES, by: str = "region_id") -> tuple[DataFrame, DataFrame]:
    """(tiles, edges by row): tiles (region, row, col, is_outline) that a region touches or fills,
    and every edge once for each row of tiles that it passes."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    by_row = cut_lineage(_edges(boundaries, by).select(by, "x1", "y1", "x2", "y2", F.explode(_steps(low, high, size)).alias("row")))
    level = F.col("y1") == F.col("y2")
    bottom, top = F.greatest(low, F.col("row") * size), F.least(high, (F.col("row") + 1) * size)
    a = F.when(level, F.col("x1")).otherwise(_x_at(bottom))
    b = F.when(level, F.col("x2")).otherwise(_x_at(top))
    outline = by_row.select(by, "row", a.alias("a"), b.alias("b")).select(
        by, "row", F.explode(_steps(F.least("a", "b"), F.greatest("a", "b"), size)).alias("col"), F.lit(True).alias("is_outline"))
    middle = (F.col("row") + 0.5) * size
    crossing = by_row.filter((low <= middle) & (middle < high)).select(by, "row", _x_at(middle).alias("x"))
    along = Window.partitionBy(by, "row").orderBy("x")
    spans = crossing.withColumns({"n": F.row_number().over(along), "next": F.lead("x").over(along)}).filter("n % 2 = 1")
    first, last = F.ceil(F.col("x") / size).cast("bigint"), (F.floor(F.col("next") / size) - 1).cast("bigint")
    inside = spans.filter(first <= last).select(by, "row", F.explode(F.sequence(first, last)).alias("col"), F.lit(False).alias("is_outline"))
    tiles = outline.unionByName(inside).groupBy(by, "row", "col").agg(F.max("is_outline").alias("is_outline"))
    return tiles, by_row


def _decided(tiles: DataFrame, edges: DataFrame, size: float, by: str) -> DataFrame:
    """Tiles that hold points of the region: (region, row, col, odd, edges). A point there is inside
    when its crossings with `edges`, flat runs of x1, y1, x2, y2, are odd, or even where `odd`."""
    # A level edge crosses nothing, nor does one without an end's place.
    sloped = edges.filter((F.least("y1", "y2") < F.greatest("y1", "y2")) & F.col("x1").isNotNull() & F.col("x2").isNotNull())
    passing = sloped.groupBy(by, "row").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    south, north = F.col("row") * size - _MARGIN, (F.col("row") + 1) * size + _MARGIN
    west, east = F.col("col") * size - _MARGIN, (F.col("col") + 1) * size + _MARGIN

    def alike(e: Column) -> Column:
        return (F.least(e["x1"], e["x2"]) > east) & (F.least(e["y1"], e["y2"]) < south) & (F.greatest(e["y1"], e["y2"]) > north)

    def compared(e: Column) -> Column:
        return (F.greatest(e["x1"], e["x2"]) >= west) & ~alike(e)

    runs = F.flatten(F.transform(F.filter("edges", compared), lambda e: F.array(e["x1"], e["y1"], e["x2"], e["y2"])))
    outline = tiles.filter("is_outline").join(passing, [by, "row"]).select(
        by, "row", "col", (F.size(F.filter("edges", alike)) % 2 == 1).alias("odd"), runs.alias("edges"))
    inside = tiles.filter("NOT is_outline").select(
        by, "row", "col", F.lit(True).alias("odd"), F.array().cast("array<double>").alias("edges"))
    return outline.filter(F.col("odd") | (F.size("edges") > 0)).unionByName(inside)


def _inside(x: Column, y: Column, most: int) -> Column:
    """Whether the crossings to the east of (x, y) are odd, of a row of `_decided` with at most `most` edges."""
    def crossed(at: Column | int) -> Column:
        x1, y1, x2, y2 = (F.get("edges", at + i if isinstance(at, Column) else F.lit(at + i)) for i in range(4))
        # From the lower end up to, not including, the upper.
        return ((y1 <= y) != (y2 <= y)) & (x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x)

    odd = F.col("odd")
    for k in range(min(UNROLLED, most)):
        odd = odd != F.when(F.size("edges") > 4 * k, crossed(4 * k)).otherwise(False)
    if most <= UNROLLED:
        return odd
    # A function over a list anywhere in it would keep all of the test out of generated code.
    further = F.filter(F.sequence(F.lit(4 * UNROLLED), F.size("edges") - 4, F.lit(4)), crossed)
    return F.when(F.size("edges") <= 4 * UNROLLED, odd).otherwise(odd != (F.size(further) % 2 == 1))


def regions_of_points(
    points: DataFrame, boundaries: DataFrame, point_id: str, at: tuple[str, str] = ("lat", "lon"),
    size: float = TILE_DEGREES, by: str = "region_id",
) -> DataFrame:
    """(point id, region): every region that a point lies in; a point in none has no row.

    A ring's points may run either way round, holes are out by counting crossings, and of two
    regions that share a border a point on it is in one: a crossing counts from an edge's lower
    end up to, not including, its upper. Longitudes of points may be given in any turn. Points without coordinates have no row;
    point ids must be unique.
    """
    tiles = cut_lineage(_decided(*tile_index(boundaries, size, by), size, by))
    west, east, longest = tiles.agg(F.min("col"), F.max("col"), F.max(F.size("edges"))).first()
    lat, lon = F.col(at[0]).cast("double"), F.col(at[1]).cast("double")
    once = F.pmod(lon + 180, F.lit(360.0)) - 180
    # Outlines may run up to half a turn over either end of the map.
    turned = F.when((lon >= -180) & (lon < 180), lon).otherwise(once)
    seen = points.filter(lat.isNotNull() & lon.isNotNull()).select(
        point_id, lat.alias("y"), F.explode(F.array(turned, turned - 360, turned + 360)).alias("x"))
    spread = seen.select(
        point_id, "x", "y", F.floor(F.col("y") / size).cast("bigint").alias("row"), F.floor(F.col("x") / size).cast("bigint").alias("col"))
    # A turn in which no region lies is not sent; a point meets its tiles with their edges, so that
    # it is decided where it meets them and pairs of point and region are never shuffled.
    met = spread.filter(F.col("col").between(F.lit(west), F.lit(east))).join(tiles, ["row", "col"])
    return met.filter(_inside(F.col("x"), F.col("y"), (longest or 0) // 4)).select(point_id, by)
