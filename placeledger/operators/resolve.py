"""Resolving a name to exactly one boundary through prioritised keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from placeledger.operators.joins import lookup


def administrative_relations(elements: DataFrame) -> DataFrame:
    """Boundary candidates: relations tagged as an administrative boundary. `elements`
    has type, id and a `tags` map."""
    return elements.filter(
        (F.col("type") == "relation") & (F.element_at("tags", "boundary") == "administrative")
    )


def candidate_keys(relations: DataFrame) -> DataFrame:
    """(kind, key, id) for every way a relation can be looked up."""
    tagged = [("iso", "ISO3166-2"), ("wikidata", "wikidata"), ("name:ru", "name:ru"), ("name", "name")]
    keys = F.array(
        F.struct(F.lit("id").alias("kind"), F.col("id").cast("string").alias("key")),
        *[F.struct(F.lit(k).alias("kind"), F.element_at("tags", tag).alias("key")) for k, tag in tagged],
    )
    return relations.select("id", F.inline(F.filter(keys, lambda k: k["key"].isNotNull())))


def resolve_keys(wanted: DataFrame, candidates: DataFrame) -> DataFrame:
    """Status per name: resolved with its id, ambiguous, or unresolved.

    `wanted` is `sources.dimensions.region_keys`: the first key that has any hit must
    have exactly one. Hits per key are counted before the join, so a common name
    adds one row, not one per hit.
    """
    counted = candidates.groupBy("kind", "key").agg(
        F.countDistinct("id").alias("n"), F.min("id").alias("_id")
    )
    found = lookup(wanted, counted, ["kind", "key"], "left")
    first = F.min(
        F.when(F.col("n").isNotNull(), F.struct("priority", "n", "_id", "kind", "key"))
    ).alias("hit")
    best = found.groupBy("name").agg(first)
    status = (
        F.when(F.col("hit").isNull(), "unresolved")
        .when(F.col("hit.n") > 1, "ambiguous")
        .otherwise("resolved")
    )
    return best.select(
        "name", status.alias("status"),
        F.when(F.col("hit.n") == 1, F.col("hit._id")).alias("id"),
        F.col("hit.kind").alias("kind"), F.col("hit.key").alias("key"),
        F.coalesce("hit.n", F.lit(0).cast("bigint")).alias("candidates"),
    )
