"""Closed rings from loose pieces of outline, in any order and direction.

Every piece is two darts, one a direction. A dart leads to the dart of the other piece that
begins where it ends; at a dead end it leads back along its own piece. So darts form cycles, a
ring two of them (one a direction), an open chain one that holds both directions of each piece.
Cycles are named and numbered by pointer doubling: in every round each dart learns of twice as
many darts ahead, so a ring of n pieces takes log n rounds of joins and no walk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from placeledger.operators.joins import lookup
from placeledger.session import cut_lineage, drop_step, write_step

GROUP = ("boundary_id", "is_hole")


def _end(points: Column) -> Column:
    return points[F.size(points) - 1]


def _same(a: Column, b: Column) -> Column:
    return (a["lon"] == b["lon"]) & (a["lat"] == b["lat"])


def _next_darts(ways: DataFrame) -> DataFrame:
    """(group, dart, ahead): a dart is 2 * number of its way, plus 1 where it runs backwards.

    Where more than two ends meet, they are paired in the order of their ways, and an odd one is
    a dead end.
    """
    first, last = F.col("points")[0], _end(F.col("points"))
    ends = ways.select(*GROUP, F.inline(F.array(
        # A way's end belongs to the dart that arrives there; its mirror leaves from it.
        F.struct(last["lon"].alias("lon"), last["lat"].alias("lat"), (F.col("way") * 2).alias("dart"), (F.col("way") * 2 + 1).alias("leaves")),
        F.struct(first["lon"].alias("lon"), first["lat"].alias("lat"), (F.col("way") * 2 + 1).alias("dart"), (F.col("way") * 2).alias("leaves")),
    )))
    at = Window.partitionBy(*GROUP, "lon", "lat").orderBy("dart")
    placed = ends.withColumns({"n": F.row_number().over(at), "after": F.lead("leaves").over(at), "prior": F.lag("leaves").over(at)})
    other = F.when(F.col("n") % 2 == 1, F.col("after")).otherwise(F.col("prior"))
    return placed.select(*GROUP, "dart", F.coalesce(other, "leaves").alias("ahead"))


def _doubled(darts: DataFrame, rounds: int, learn: dict[str, Column]) -> DataFrame:
    """`darts` after so many rounds: each takes over from the dart `ahead` of it, its own columns
    with `_` before their names, and looks twice as far."""
    spark = darts.sparkSession
    held, step = write_step(darts)
    columns = [c for c in darts.columns if c not in GROUP and c != "dart"]
    for _ in range(rounds):
        further = held.select(*GROUP, F.col("dart").alias("ahead"), *[F.col(c).alias(f"_{c}") for c in columns])
        joined = held.join(further, [*GROUP, "ahead"], "left")
        after, next_step = write_step(joined.select(*GROUP, "dart", *[learn[c].alias(c) for c in columns]))
        drop_step(spark, step)
        held, step = after, next_step
    return held


def assemble_rings(
    pieces: DataFrame, boundary_id: str = "boundary_id", way_id: str = "way_id", role: str = "role", points: str = "points",
) -> tuple[DataFrame, DataFrame]:
    """(rings, open chains) of pieces with points array<struct<lon, lat>>.

    Rings: boundary_id, ring_id (the smallest way), is_hole, n_ways, points (closed, begins with
    the smallest way, in its direction). Open chains: boundary_id, is_hole, ways (those that
    miss a neighbour, as a list). Role `inner` makes holes, any other outer rings; the two never
    join. Pieces of under two points, and repeats of a way, are left out; a piece that
    ends where it begins is a ring. Ways are told apart by numbers. An empty table gives none.
    """
    known = pieces.select(
        F.col(boundary_id).alias("boundary_id"), F.col(way_id).cast("bigint").alias("way"),
        F.coalesce(F.col(role) == "inner", F.lit(False)).alias("is_hole"), F.col(points).alias("points"),
    ).filter("size(points) > 1")
    ways = cut_lineage(known.groupBy(*GROUP, "way").agg(F.min_by("points", F.xxhash64("points")).alias("points")))
    closed = _same(F.col("points")[0], _end(F.col("points")))
    darts = _next_darts(ways.filter(~closed))
    # A cycle has at most two darts a way of its boundary.
    most = ways.groupBy(*GROUP).count().agg(F.max("count")).first()[0] or 0
    rounds = max(1, (2 * most - 1).bit_length())
    named = _doubled(darts.withColumn("low", F.col("dart")), rounds, {
        "ahead": F.col("_ahead"), "low": F.least("low", "_low")}).select(*GROUP, "dart", "low")
    named = cut_lineage(named)
    # A chain has both directions of its ways in one cycle. Of a ring the cycle that runs along its smallest way stays.
    way = F.floor(F.col("dart") / 2).cast("bigint")
    sides = named.groupBy(*GROUP, "low", way.alias("way")).agg(F.count("*").alias("sides"))
    cycles = sides.groupBy(*GROUP, "low").agg((F.max("sides") == 2).alias("is_open"), F.array_sort(F.collect_list("way")).alias("ways"))
    chains = cycles.filter("is_open").select("boundary_id", "is_hole", "ways")
    kept = cycles.filter("NOT is_open AND low % 2 = 0").select(*GROUP, "low")
    # Cut before its first dart a cycle is a list; what is left of it from a dart numbers it backwards.
    listed = lookup(darts, named, [*GROUP, "dart"]).join(kept, [*GROUP, "low"])
    cut = listed.withColumn("ahead", F.when(F.col("ahead") != F.col("low"), F.col("ahead"))).withColumn("left", F.lit(1))
    steps = _doubled(cut.select(*GROUP, "dart", "ahead", "left", "low"), rounds, {
        "ahead": F.col("_ahead"), "left": F.col("left") + F.coalesce("_left", F.lit(0)), "low": F.col("low")})
    along = steps.select(*GROUP, "low", (-F.col("left")).alias("place"), way.alias("way"), (F.col("dart") % 2 == 1).alias("backwards"))
    alone = ways.filter(closed).select(
        *GROUP, (F.col("way") * 2).alias("low"), F.lit(0).alias("place"), "way", F.lit(False).alias("backwards"))
    laid = lookup(along.unionByName(alone), ways, [*GROUP, "way"]).withColumn(
        "points", F.when(F.col("backwards"), F.reverse("points")).otherwise(F.col("points")))
    # A way's last point is the next one's first.
    parts = F.array_sort(F.collect_list(F.struct("place", F.slice("points", F.lit(1), F.size("points") - 1).alias("points"))))
    rings = laid.groupBy(*GROUP, "low").agg(F.count("*").alias("n_ways"), F.flatten(F.transform(parts, lambda p: p["points"])).alias("open"))
    return rings.select(
        "boundary_id", F.expr("low div 2").alias("ring_id"), "is_hole", "n_ways",
        F.concat("open", F.slice("open", 1, 1)).alias("points")), chains
