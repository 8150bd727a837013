"""Which sightings are the same entity: against known entities, and among themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeledger.functions.geo import coordinate_key
from placeledger.functions.text import normalize_phone, normalize_text
from placeledger.operators.joins import lookup
from placeledger.operators.stage import stage
from placeledger.session import cut_lineage, drop_step, write_step

# Levels of evidence, strongest first. The first is global, the others hold inside a region.
LEVELS = ("external_id", "name_address", "name_phone", "name_point")


def with_identity_texts(df: DataFrame) -> DataFrame:
    """Add normalized_name, normalized_address and normalized_phone."""
    return df.withColumns(
        {
            "normalized_name": normalize_text("name"),
            "normalized_address": normalize_text("address"),
            "normalized_phone": normalize_phone("phone"),
        }
    )


def with_keys(df: DataFrame, phone: str = "normalized_phone") -> DataFrame:
    """Add `keys`: array<struct<level, key>> of the identity keys a row has.

    A key carries its scope, so one equality compares level, region and value.
    """
    def key(level: int, *parts: str) -> Column:
        # concat is NULL as soon as one part is missing, which drops the key.
        joined = [piece for part in parts for piece in (F.lit("\x1f"), F.col(part).cast("string"))]
        return F.struct(F.lit(level).alias("level"), F.concat(F.lit(str(level)), *joined).alias("key"))

    ready = stage(
        df, _point=coordinate_key("latitude", "longitude"), _external=F.nullif("external_id", F.lit(""))
    )
    every = F.array(
        key(0, "external_source", "_external"),
        key(1, "region_id", "normalized_name", "normalized_address"),
        key(2, "region_id", "normalized_name", phone),
        key(3, "region_id", "normalized_name", "_point"),
    )
    return stage(ready, keys=F.filter(every, lambda k: k["key"].isNotNull())).drop("_point", "_external")


def match_existing(obs: DataFrame, current: DataFrame) -> DataFrame:
    """Known entity of every sighting: seq, entity_id, level (both NULL when new).

    `obs` needs seq and the identity columns; `current` is the salon table, whose
    `phone` is already normalised. The strongest level that hits wins, then the lowest
    entity id. Known keys are reduced to one row each, so the join never multiplies;
    a key shared by very many sightings is split by adaptive skew handling, and the
    final minimum sees at most five rows a sighting.
    """
    known = with_keys(current, "phone").select(F.col("id").alias("_id"), F.inline("keys"))
    known = known.groupBy("key").agg(F.min("_id").alias("entity_id"))
    wanted = with_keys(obs).select("seq", F.inline("keys"))
    hits = lookup(wanted, known, "key").select("seq", F.struct("level", "entity_id").alias("hit"))
    # Sightings without any hit keep a row through the aggregate, without a second join.
    everyone = obs.select("seq", F.lit(None).cast(hits.schema["hit"].dataType).alias("hit"))
    # A sighting's few hits lie in different tasks: sorting them there to combine them would combine nothing.
    best = hits.unionByName(everyone).repartition("seq").groupBy("seq").agg(F.min("hit").alias("hit"))
    return best.select("seq", "hit.entity_id", "hit.level")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for an undirected edge list (a, b); a component is named by
    its smallest node.

    Every round each node is pointed at the smallest node it knows of, first for its
    larger neighbours, then for its smaller ones, until the edges are stars. Edges
    never multiply, path lengths shrink by a factor per round, and a node with very
    many edges is only ever on the many side of a join against one row. Rounds are
    cut by a table written to the shared folder, so a lost executor repeats one round; a
    round's table goes when the next one is written. No join sends a side through the driver.
    """
    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("a").agg(F.min("b").alias("least"))

    def large_star(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = least(both).select("a", F.least("a", "least").alias("least"))
        return lookup(both, low, "a", broadcast=False).filter(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("least").alias("b")
        ).filter("a <> b").distinct()

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = least(down)
        rest = lookup(down, low, "a", broadcast=False).select(F.col("b").alias("a"), F.col("least").alias("b"))
        own = low.select("a", F.col("least").alias("b"))
        return rest.unionByName(own).filter("a <> b").distinct()

    def open_nodes(e: DataFrame) -> int:
        # In a star every leaf points once, and no root points anywhere.
        ends = e.select(F.inline(F.array(
            F.struct(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")),
            F.struct(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")),
        )))
        degrees = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        return degrees.filter("out > 1 OR (out > 0 AND into > 0)").count()

    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    links, step = write_step(small_star(edges.filter("a <> b")))
    while open_nodes(links):
        after, next_step = write_step(small_star(large_star(links)))
        drop_step(edges.sparkSession, step)
        links, step = after, next_step
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("_root")).hint("merge")
    return nodes.join(roots, "node", "left").select(
        "node", F.coalesce("_root", "node").alias("component")
    )


def resolve_batch(obs: DataFrame) -> DataFrame:
    """Same-entity groups inside one batch: seq, component (the smallest seq of the group).

    Sightings with identical keys are folded first, and each key links its sightings to
    its smallest one, so n sightings of a key make n links, never n * n. Grouping is
    independent of arrival order. It differs from row-by-row merging when a later
    sighting bridges two entities that were separate so far (row by row picks one and
    leaves the other), and when a merge would have overwritten a key that a later
    sighting needs.
    """
    keyed = cut_lineage(with_keys(obs).select("seq", "keys"))
    # Two sightings under one number would silently become one entity.
    if keyed.groupBy("seq").agg(F.count("*").alias("n")).filter("n > 1 OR seq IS NULL").limit(1).count():
        raise ValueError("every sighting needs a seq of its own")
    folded = keyed.groupBy("keys").agg(F.min("seq").alias("node"))
    # A sighting without any key is an entity of its own.
    keyless, linked = keyed.filter(F.size("keys") == 0), folded.filter(F.size("keys") > 0)
    per_key = linked.select("node", F.inline("keys")).select("node", "key")
    hubs = per_key.groupBy("key").agg(F.min("node").alias("hub"))
    edges = lookup(per_key, hubs, "key").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    components = connected_components(edges)
    named = linked.join(components, "node").select("keys", "component")
    members = lookup(keyed.filter(F.size("keys") > 0), named, "keys").select("seq", "component")
    return members.unionByName(keyless.select("seq", F.col("seq").alias("component")))
