"""Classifier input rebuilt from stored rows, and what a new run would change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeledger.fixed_values import ENTITY_WORDS, PROVIDER
from placeledger.functions import jsons as J
from placeledger.functions.text import blank_to_null
from placeledger.operators.classify import classify_entities
from placeledger.operators.eligibility import due_for_reclassification
from placeledger.operators.parse_search import category_names, rubric_names
from placeledger.operators.stage import stage

_EMPTY = "array<string>"


def _payload_first(path: str, column: str) -> Column:
    """Truthy payload value, else the stored column; blank counts as missing."""
    value = J.scalar_text(J.if_truthy(J.get(F.col("_payload"), path)))
    return J.nonblank(F.coalesce(value, F.col(column)))


def classifier_input(salons: DataFrame) -> DataFrame:
    """Stored rows with the classifier's input: payload first, row second; categories
    from the column, else from the payload's rubrics. Adds `reliable`, `issue` and
    `input_snapshot`; previous decision columns get the prefix `previous_`."""
    read = stage(salons, _payload=J.lenient_object("raw_payload"))
    name = J.scalar_text(J.if_truthy(J.get(F.col("_payload"), "$.name")))
    stored = F.filter(
        F.coalesce("categories", F.array().cast(_EMPTY)), lambda c: c.isNotNull() & (c != "")
    )
    built = read.select(
        "id",
        F.coalesce(
            *[blank_to_null(c) for c in ("external_source", "source") if c in salons.columns], F.lit(PROVIDER)
        ).alias("external_source"),
        J.nonblank(F.col("external_id")).alias("external_id"),
        F.coalesce(name, F.col("name"), F.lit("")).alias("name"),
        F.col("name").alias("stored_name"),
        F.when(F.size(stored) > 0, stored).otherwise(rubric_names(F.col("_payload"))).alias("categories"),
        _payload_first("$.address_name", "address").alias("address"),
        _payload_first("$.description", "description").alias("description"),
        J.nonblank(F.col("filter_status")).alias("previous_status"),
        J.nonblank(F.col("business_profile")).alias("previous_profile"),
        J.nonblank(F.col("rejection_reason")).alias("previous_rejection"),
    )
    reliable = (F.col("name") != "") & (F.size("categories") > 0)
    snapshot = F.to_json(F.struct("id", "name", "external_source", "address", "categories", "description"))
    return built.withColumns(
        {
            "reliable": reliable,
            "issue": F.when(~reliable, "missing_name_or_categories"),
            "input_snapshot": snapshot,
        }
    )


def reclassify(salons: DataFrame, version: str | None = None, words: dict = ENTITY_WORDS,
               salon_id: int | None = None, limit: int | None = None) -> DataFrame:
    """Decision of every due row next to its stored one, with `changed`. Nothing is
    written: applying it is `apply_classification`, leaving that out is the dry run."""
    due = due_for_reclassification(salons, version, limit, salon_id)
    decided = classify_entities(classifier_input(due), words)
    new_status = F.when(F.col("accepted"), "accepted").otherwise("rejected")
    changed = (
        ~F.col("previous_status").eqNullSafe(new_status)
        | ~F.col("previous_profile").eqNullSafe(F.col("business_profile"))
        | ~F.col("previous_rejection").eqNullSafe(F.col("rejection_reason"))
    )
    return decided.withColumn("new_status", new_status).withColumn("changed", changed)


def reclassify_counters(changes: DataFrame) -> DataFrame:
    return changes.agg(
        F.count("*").alias("processed"),
        F.count_if("changed").alias("changed"),
        F.count_if("accepted").alias("accepted"),
        F.count_if(~F.col("accepted")).alias("rejected"),
        F.count_if(~F.col("reliable")).alias("unreliable"),
    )


def organization_of_discovery(discoveries: DataFrame, raw: DataFrame) -> DataFrame:
    """Discoveries with the organisation rebuilt from their raw payload (`org`)."""
    raws = raw.select(
        F.col("id").alias("raw_result_id"), F.col("payload").alias("_raw"),
        F.col("name").alias("raw_name"), F.col("fetched_at").alias("raw_fetched_at"),
    )
    read = stage(discoveries.join(raws, "raw_result_id", "left"), _payload=J.lenient_object("_raw"))
    p = F.col("_payload")

    def text(path: str) -> Column:
        return J.nonblank(J.text_at(p, path))

    name = J.scalar_text(J.if_truthy(J.get(p, "$.name")))
    address = J.first_truthy(J.get(p, "$.address_name"), J.get(p, "$.address"))
    org = F.struct(
        "external_source",
        J.nonblank(F.col("external_id")).alias("external_id"),
        F.coalesce(name, F.col("raw_name"), F.lit("")).alias("name"),
        J.nonblank(J.scalar_text(address)).alias("address"),
        J.get(p, "$.point.lat", "double").alias("latitude"),
        J.get(p, "$.point.lon", "double").alias("longitude"),
        category_names(p).alias("categories"),
        text("$.description").alias("description"),
        text("$.schedule").alias("working_hours"),
        text("$.org").alias("branch_info"),
        F.col("_raw").alias("raw_payload"),
        blank_to_null("query").alias("discovered_query"),
        F.col("grid_cell_id").alias("discovered_grid_cell_id"),
        F.col("raw_fetched_at").alias("fetched_at"),
    )
    return stage(read, org=org).drop("_payload", "_raw", "raw_name", "raw_fetched_at")
