"""Regions, region aliases, query profiles, and their refresh."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from placeledger.fixed_values import DEFAULT_QUERY_PROFILE, QUERY_PROFILES, REGIONS


def regions(spark: SparkSession, rows: Sequence[tuple] = REGIONS) -> DataFrame:
    """Ordered region list: scan_order, name, iso3166_2."""
    return spark.createDataFrame(list(rows), "scan_order int, name string, iso3166_2 string")


def region_keys(metadata: DataFrame) -> DataFrame:
    """One row per way to look a region up, best first.

    `metadata` has name, iso3166_2, and optionally pinned_id, wikidata and aliases.
    A pinned id comes before the ISO code, then the wikidata id, then each name and
    alias, first as a localised name and then as a plain one.
    """
    optional = {"pinned_id": "string", "iso3166_2": "string", "wikidata": "string", "aliases": "array<string>"}
    full = metadata.select(
        "name",
        *[
            (F.col(c) if c in metadata.columns else F.lit(None)).cast(t).alias(c)
            for c, t in optional.items()
        ],
    )

    def key(kind: str, value) -> F.Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("key"))

    names = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    by_name = F.flatten(F.transform(names, lambda n: F.array(key("name:ru", n), key("name", n))))
    keys = F.concat(
        F.array(
            key("id", F.col("pinned_id")), key("iso", F.col("iso3166_2")), key("wikidata", F.col("wikidata"))
        ),
        by_name,
    )
    present = F.filter(keys, lambda k: F.coalesce(k["key"], F.lit("")) != "")
    return full.select("name", F.posexplode(present).alias("priority", "k")).select(
        "name", "priority", "k.kind", "k.key"
    )


def with_short_names(metadata: DataFrame) -> DataFrame:
    """Add the usual short form of a region type as an alias (`область` as `обл.`)."""
    short = F.when(
        F.col("name").endswith(" область"), F.regexp_replace("name", "область$", "обл.")
    ).when(F.col("name").startswith("Республика "), F.regexp_replace("name", "^Республика ", ""))
    known = F.col("aliases") if "aliases" in metadata.columns else F.array().cast("array<string>")
    return metadata.withColumn(
        "aliases", F.filter(F.array_distinct(F.concat(F.array(short), known)), lambda a: a.isNotNull())
    )


def query_list(name: str | None = None, explicit: Sequence[str] | None = None,
               profiles: dict[str, list[str]] = QUERY_PROFILES) -> tuple[str, list[str]]:
    """Resolve a profile name or an explicit list to (name, queries)."""
    if explicit is not None:
        kept = [query for query in explicit if query.strip()]
        if not kept:
            raise ValueError("the explicit query list is empty")
        return name or "explicit", kept
    chosen = name or DEFAULT_QUERY_PROFILE
    if chosen not in profiles:
        raise ValueError(f"unknown query profile: {chosen}")
    return chosen, list(profiles[chosen])


def query_profile(spark: SparkSession, name: str | None = None,
                  explicit: Sequence[str] | None = None) -> DataFrame:
    """The resolved profile as rows: profile, pos, query."""
    chosen, queries = query_list(name, explicit)
    rows = [(chosen, pos, query) for pos, query in enumerate(queries)]
    return spark.createDataFrame(rows, "profile string, pos int, query string")


def scan_plan(cells: DataFrame, queries: Sequence[str]) -> DataFrame:
    """One row per cell and query. The query list rides along as a constant, so no
    join and no shuffle is needed."""
    asked = F.array(*[F.lit(q) for q in queries])
    return cells.select("*", F.posexplode(asked).alias("query_pos", "query"))


def sync_regions(current: DataFrame, listed: DataFrame) -> DataFrame:
    """Current regions refreshed from the list: known names take the listed order, new
    names start as pending without an id, names no longer listed keep everything and
    move out of the way to order -id."""
    both = current.withColumnRenamed("scan_order", "_old").join(
        listed.select("name", F.col("scan_order").alias("_new")), "name", "full"
    )
    return both.withColumn("scan_order", F.coalesce("_new", -F.col("id"))).withColumn(
        "status", F.when(F.col("id").isNull(), "pending").otherwise(F.col("status"))
    ).drop("_old", "_new")
