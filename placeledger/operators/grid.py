"""Boundary polygons to square grid cells in metres."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from placeledger.fixed_values import GRID_SIZE_METERS
from placeledger.functions.geo import (
    circular_mean,
    normalize_longitude,
    project_local,
    unproject_local,
    unwrap_longitude,
)
from placeledger.operators.joins import lookup
from placeledger.operators.stage import stage


def longitude_stats(points: DataFrame, by: str = "region_id", lon: str = "lon") -> DataFrame:
    """Per group: circular mean, width as given, and width once unwrapped around the
    mean, with `unwrap` set when the unwrapped form is the narrower one of a group
    wider than half the globe."""
    means = points.groupBy(by).agg(
        F.sum(F.sin(F.radians(lon))).alias("_sin"), F.sum(F.cos(F.radians(lon))).alias("_cos"),
        F.min(lon).alias("_min"), F.max(lon).alias("_max"),
    ).select(by, circular_mean(F.col("_sin"), F.col("_cos")).alias("mean_lon"), (F.col("_max") - F.col("_min")).alias("width"))
    shifted = lookup(points.select(by, lon), means, by).withColumn("_u", unwrap_longitude(lon, "mean_lon"))
    widths = shifted.groupBy(by).agg((F.max("_u") - F.min("_u")).alias("unwrapped_width"))
    return means.join(widths, by).withColumn(
        "unwrap", (F.col("width") > 180) & (F.col("unwrapped_width") < F.col("width"))
    )


def _points(rings: Column) -> Column:
    return F.flatten(F.transform(rings, lambda r: r["points"]))


def _span(values: Column) -> Column:
    return F.array_max(values) - F.array_min(values)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def _map_points(rings: Column, body) -> Column:
    return F.transform(rings, lambda r: r.withField("points", F.transform(r["points"], body)))


def framed_boundaries(boundaries: DataFrame, size: float = GRID_SIZE_METERS, by: str = "region_id") -> DataFrame:
    """Boundaries in local metres: `rings` with x and y, the projection centre (middle
    of the unwrapped bounding box), bounds, and the grid's size in cells.

    A boundary is one row with its rings, so everything about it is computed inside
    that row: no shuffle, no join, and the plan stays as long as this function.
    """
    def lons(c: str) -> Column:
        return F.transform(_points(F.col(c)), lambda p: p["lon"])

    df = boundaries.select(by, F.col("rings").alias("_given"))
    df = stage(df, _lons=lons("_given"))
    radians = lambda f: F.transform("_lons", lambda v: f(F.radians(v)))
    df = stage(df, _mean=circular_mean(_sum(radians(F.sin)), _sum(radians(F.cos))))
    df = stage(df, _turned=F.transform("_lons", lambda v: unwrap_longitude(v, F.col("_mean"))))
    df = stage(df, unwrapped=(_span(F.col("_lons")) > 180) & (_span(F.col("_turned")) < _span(F.col("_lons"))))
    turned = _map_points(
        F.col("_given"), lambda p: p.withField("lon", unwrap_longitude(p["lon"], F.col("_mean")))
    )
    df = stage(df, _placed=F.when(F.col("unwrapped"), turned).otherwise(F.col("_given")))
    lats = F.transform(_points(F.col("_placed")), lambda p: p["lat"])
    df = stage(df, _lons=lons("_placed"), _lats=lats)
    middle = lambda c: (F.array_min(c) + F.array_max(c)) / 2
    df = stage(df, lon0=middle("_lons"), lat0=middle("_lats"))
    df = stage(df, rings=_map_points(
        F.col("_placed"), lambda p: project_local(p["lon"], p["lat"], F.col("lon0"), F.col("lat0"))
    ))
    df = stage(df, _xy=_points(F.col("rings")))
    bounds = {
        f"{name}_{axis}": pick(_axis(axis))
        for axis in "xy" for name, pick in (("min", F.array_min), ("max", F.array_max))
    }
    df = stage(df, **bounds).select(by, "rings", "unwrapped", "lon0", "lat0", *bounds)
    steps = lambda axis: F.ceil((F.col(f"max_{axis}") - F.col(f"min_{axis}")) / size).cast("bigint")
    return df.withColumns({"n_cols": steps("x"), "n_rows": steps("y")})


def _axis(axis: str) -> Column:
    return F.transform("_xy", lambda p: p[axis])


def ring_edges(framed: DataFrame, *keep: str) -> DataFrame:
    """One row per edge of every ring, rings closed: x1, y1, x2, y2. Each edge comes
    from its own ring alone, so this is a narrow step; edges without length are left
    out."""
    rings = framed.select(*keep, F.explode("rings").alias("ring"))
    points = F.col("ring.points")
    following = F.concat(F.slice(points, F.lit(2), F.size(points)), F.slice(points, 1, 1))
    edges = rings.select(*keep, F.explode(F.arrays_zip(points.alias("a"), following.alias("b"))).alias("e"))
    ends = edges.select(
        *keep, *[F.col(f"e.{end}.{axis}").alias(f"{axis}{n}") for n, end in (("1", "a"), ("2", "b")) for axis in "xy"]
    )
    return ends.filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def _touched(low: Column, high: Column, n: Column, size: float) -> Column:
    """Indexes of the steps that the closed interval meets; a value on a grid line
    belongs to both sides."""
    first = F.greatest((F.ceil(low / size) - 1).cast("bigint"), F.lit(0).cast("bigint"))
    last = F.least(F.floor(high / size).cast("bigint"), n - 1)
    return F.when(first <= last, F.sequence(first, last))


def grid_cells(boundaries: DataFrame, size: float = GRID_SIZE_METERS, by: str = "region_id") -> DataFrame:
    """Numbered cells of every boundary that meet its polygons, in row-major order from
    the south-west: cell_order, row, col, bounds and centre in degrees.

    Cells on the outline come from walking each edge through the rows and columns it
    touches. Cells inside come from the pairs of crossings of a row's middle line. Work
    and rows grow with the edges and the cells found, never with cells times polygons.
    Shuffles are keyed by region and grid row, so one huge region spreads over many
    tasks; a row has at most the Earth's girth divided by the cell size.
    """
    framed = framed_boundaries(boundaries, size, by)
    frame = ["min_x", "min_y", "max_x", "max_y", "n_cols", "n_rows"]
    local = stage(
        ring_edges(framed, by, *frame),
        height=F.col("max_y") - F.col("min_y"),
        **{f"{axis}{end}": F.col(f"{axis}{end}") - F.col(f"min_{axis}") for axis in "xy" for end in "12"},
    )

    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = F.explode(_touched(low, high, F.col("n_rows"), size)).alias("row")
    by_row = local.select(by, "x1", "y1", "x2", "y2", "height", "n_cols", rows)
    slope = (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    level = F.col("y1") == F.col("y2")

    def x_at(y: Column) -> Column:
        return F.col("x1") + (y - F.col("y1")) * slope

    bottom = F.greatest(low, F.col("row") * size)
    top = F.least(high, (F.col("row") + 1) * size)
    xa = F.when(level, F.col("x1")).otherwise(x_at(bottom))
    xb = F.when(level, F.col("x2")).otherwise(x_at(top))
    outline = stage(by_row, xa=xa, xb=xb).select(
        by, "row", "n_cols", F.least("xa", "xb").alias("a"), F.greatest("xa", "xb").alias("b")
    ).select(
        by, "row", F.explode(_touched(F.col("a"), F.col("b"), F.col("n_cols"), size)).alias("col")
    )

    middle = (F.col("row") * size + F.least((F.col("row") + 1) * size, F.col("height"))) / 2
    crossing = by_row.withColumn("_mid", middle).filter((low <= F.col("_mid")) & (F.col("_mid") < high)).select(
        by, "row", x_at(F.col("_mid")).alias("x")
    )
    along = W.partitionBy(by, "row").orderBy("x")
    spans = crossing.withColumns({"_n": F.row_number().over(along), "_next": F.lead("x").over(along)}).filter(
        F.col("_n") % 2 == 1
    )
    first = F.ceil(F.col("x") / size).cast("bigint")
    last = (F.floor(F.col("_next") / size) - 1).cast("bigint")
    inside = spans.filter(first <= last).select(by, "row", F.explode(F.sequence(first, last)).alias("col"))

    cells = outline.unionByName(inside).repartition(F.col(by), F.col("row")).dropDuplicates([by, "row", "col"])
    return _place(_number(cells, by), framed.drop("rings"), size, by)


def _number(cells: DataFrame, by: str) -> DataFrame:
    """Row-major numbers without sorting a region in one task: cells are ranked inside
    their grid row, rows are added up per region. Both groups are small by geometry."""
    ranked = cells.withColumn("_rank", F.row_number().over(W.partitionBy(by, "row").orderBy("col")))
    per_row = cells.groupBy(by, "row").agg(F.count("*").alias("_n"))
    before = W.partitionBy(by).orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_row.select(by, "row", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ranked.join(offsets, [by, "row"]).select(
        by, "row", "col", (F.col("_before") + F.col("_rank")).cast("bigint").alias("cell_order")
    )


def _place(cells: DataFrame, frames: DataFrame, size: float, by: str) -> DataFrame:
    """Cell corners and centre back in degrees. Longitudes are normalised at the end,
    so a cell on the 180th meridian may have its west edge east of its east edge."""
    placed = lookup(cells, frames, by)
    left = F.col("min_x") + F.col("col") * size
    south = F.col("min_y") + F.col("row") * size
    placed = stage(
        placed,
        x0=left, x1=F.least(left + size, F.col("max_x")), y0=south, y1=F.least(south + size, F.col("max_y")),
    )
    points = [(F.col(x), F.col(y)) for x in ("x0", "x1") for y in ("y0", "y1")]
    points.append(((F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2))
    placed = stage(
        placed,
        **{f"p{i}": unproject_local(x, y, F.col("lon0"), F.col("lat0")) for i, (x, y) in enumerate(points)},
    )
    lons = stage(placed, **{f"lon_{i}": unwrap_longitude(f"p{i}.lon", "lon0") for i in range(4)})
    west, east = F.least(*[f"lon_{i}" for i in range(4)]), F.greatest(*[f"lon_{i}" for i in range(4)])
    lats = [f"p{i}.lat" for i in range(4)]
    return lons.select(
        by, "cell_order", "row", "col",
        F.greatest(*lats).alias("north"), F.least(*lats).alias("south"),
        normalize_longitude(west).alias("west"), normalize_longitude(east).alias("east"),
        F.col("p4.lat").alias("center_lat"), normalize_longitude("p4.lon").alias("center_lon"),
    )


def grid_counts(boundaries: DataFrame, cells: DataFrame, size: float = GRID_SIZE_METERS,
                by: str = "region_id") -> DataFrame:
    """Candidate cells of the bounding box and accepted cells per boundary."""
    shaped = framed_boundaries(boundaries, size, by).select(by, (F.col("n_cols") * F.col("n_rows")).alias("candidate_cells"))
    accepted = cells.groupBy(by).agg(F.count("*").alias("accepted_cells"))
    return shaped.join(accepted, by, "left").withColumn(
        "accepted_cells", F.coalesce("accepted_cells", F.lit(0).cast("bigint"))
    )
