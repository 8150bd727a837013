"""Canonical records for rejected entities, with a report of conflicting decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from placeledger.operators.joins import lookup
from placeledger.operators.reclassify import organization_of_discovery

ENTITY = ("external_source", "external_id")
_NO_TEXTS = "array<string>"


def rejected_entities(discoveries: DataFrame, region_id: int | None = None,
                      max_records: int | None = None) -> DataFrame:
    """Entities with an id that were rejected at least once, by their last rejected
    discovery (`last_rejected_id`), at most `max_records` of them."""
    rejected = discoveries.filter((F.col("filter_status") == "rejected") & (F.trim("external_id") != ""))
    if region_id is not None:
        rejected = rejected.filter(F.col("region_id") == region_id)
    groups = rejected.groupBy(*ENTITY).agg(F.max("id").alias("last_rejected_id"))
    return groups if max_records is None else groups.orderBy("last_rejected_id").limit(max_records)


def _reason_codes():
    return F.filter(
        F.coalesce("classifier_reason_codes", F.array().cast(_NO_TEXTS)), lambda c: c.isNotNull() & (c != "")
    )


def decision_groups(discoveries: DataFrame) -> DataFrame:
    """One row per entity and distinct decision: count, first and last discovery, and
    the queries that led there. Queries are made distinct before they are listed."""
    keyed = discoveries.select(
        *ENTITY, "filter_status", "rejection_reason", "business_profile",
        _reason_codes().alias("reason_codes"), "id", F.nullif("query", F.lit("")).alias("query"),
    )
    decision = (*ENTITY, "filter_status", "rejection_reason", "business_profile", "reason_codes")
    per_query = keyed.groupBy(*decision, "query").agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )
    return per_query.groupBy(*decision).agg(
        F.sum("n").alias("n"),
        F.min("first_id").alias("first_discovery_id"),
        F.max("last_id").alias("last_discovery_id"),
        F.array_sort(F.collect_list("query")).alias("queries"),
    )


def conflict_report(discoveries: DataFrame) -> DataFrame:
    """Per entity its distinct decisions in order of first appearance, and whether they
    conflict. Decisions are few by construction, so the list stays short."""
    groups = decision_groups(discoveries)
    item = F.struct(
        "first_discovery_id", "last_discovery_id", "filter_status", "rejection_reason",
        "business_profile", "reason_codes", "queries", "n",
    )
    return groups.groupBy(*ENTITY).agg(
        F.array_sort(F.collect_list(item)).alias("decisions"),
        F.sum("n").alias("observations"),
    ).withColumn("conflict", F.size("decisions") > 1)


def backfill_plan(discoveries: DataFrame, raw: DataFrame, salons: DataFrame, region_id: int | None = None,
                  max_records: int | None = None) -> DataFrame:
    """What to do with each rejected entity: its latest discovery decides, compared
    with the stored record: create, update, unchanged, or skip when there is no id.

    Groups are reduced to their newest row by an aggregate before the raw payload is
    joined, so payloads of older sightings never move.
    """
    wanted = rejected_entities(discoveries, region_id, max_records)
    history = lookup(discoveries, wanted.select(*ENTITY), list(ENTITY), "left_semi")
    # Observations per cell first: a cell repeated a million times becomes one row.
    per_cell = history.groupBy(*ENTITY, "grid_cell_id").agg(
        F.count("*").alias("n"),
        F.max_by(F.struct(*[c for c in history.columns if c not in ENTITY]), "id").alias("_row"),
    )
    latest = per_cell.groupBy(*ENTITY).agg(
        F.max_by("_row", "_row.id").alias("_row"),
        F.sum("n").alias("observation_count"),
        F.count("grid_cell_id").alias("distinct_cells"),
    ).select(*ENTITY, "observation_count", "distinct_cells", "_row.*")
    rebuilt = organization_of_discovery(latest, raw)
    existing = salons.filter("external_id IS NOT NULL").groupBy(*ENTITY).agg(
        F.min_by(
            F.struct("id", "filter_status", "rejection_reason", "business_profile", "classifier_reason_codes"), "id"
        ).alias("_old")
    )
    conflicts = conflict_report(history).select(*ENTITY, "conflict", "decisions")
    joined = rebuilt.join(existing, list(ENTITY), "left").join(conflicts, list(ENTITY), "left")
    codes = F.coalesce("classifier_reason_codes", "filter_reasons", F.array().cast(_NO_TEXTS))
    profile = F.coalesce(F.nullif("business_profile", F.lit("")), F.lit("unknown"))
    reason = F.nullif(F.trim("rejection_reason"), F.lit(""))
    same = (
        F.col("_old.filter_status").eqNullSafe(F.col("filter_status"))
        & F.col("_old.rejection_reason").eqNullSafe(reason)
        & F.col("_old.business_profile").eqNullSafe(profile)
        & F.coalesce("_old.classifier_reason_codes", F.array().cast(_NO_TEXTS)).eqNullSafe(codes)
    )
    no_id = F.col("org.external_id").isNull()
    action = (
        F.when(no_id, "skip").when(F.col("_old").isNull(), "create").when(same, "unchanged").otherwise("update")
    )
    return joined.select(
        *ENTITY, "region_id", F.col("id").alias("discovery_id"), "raw_result_id",
        F.col("org.name").alias("name"),
        F.col("_old.id").alias("previous_salon_id"),
        F.col("_old.filter_status").alias("previous_status"),
        F.col("filter_status").alias("new_status"),
        action.alias("action"),
        reason.alias("rejection_reason"), profile.alias("business_profile"), codes.alias("reason_codes"),
        "observation_count", "distinct_cells",
        F.col("conflict").alias("conflicting_decisions"), "decisions",
        F.when(no_id, "missing_external_id").alias("issue"),
        "org",
    )


def backfill_counters(plan: DataFrame) -> DataFrame:
    def of(action: str, name: str):
        return F.count_if(F.col("action") == action).alias(name)

    return plan.agg(
        F.count("*").alias("processed"), of("create", "created"), of("update", "updated"),
        of("unchanged", "unchanged"), of("skip", "skipped"),
        F.count_if("conflicting_decisions").alias("conflicts"),
    )


def link_discoveries(discoveries: DataFrame, salons: DataFrame) -> DataFrame:
    """Fill missing `salon_id`s of discoveries from the record with the same id."""
    known = salons.filter("external_id IS NOT NULL").groupBy(*ENTITY).agg(F.min("id").alias("_salon"))
    return lookup(discoveries, known, list(ENTITY), "left").withColumn(
        "salon_id", F.coalesce("salon_id", "_salon")
    ).select(*discoveries.columns)
