"""Details and classification results applied to the current salon table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeledger.functions.text import normalize_text


def apply_details(salons: DataFrame, details: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """Salon table after a details run. A success overwrites with every value it has
    (an empty category list is no value); a failure only leaves its status and error.

    At most the latest outcome of a salon counts.
    """
    taken = ("name", "full_address", "latitude", "longitude", "categories", "description",
             "organization_id", "branch_id", "provider_updated_at")
    # `id` ties details to their outcome, and grows with time.
    facts = outcomes.select("id", "salon_id", "status", *(["error"] if "error" in outcomes.columns else [])).join(
        details.select("id", F.struct(*taken).alias("_details")), "id", "left"
    )
    latest = facts.groupBy("salon_id").agg(
        F.max_by(F.struct(*[c for c in facts.columns if c not in ("id", "salon_id")]), "id").alias("_o")
    ).select(F.col("salon_id").alias("id"), "_o")
    joined = salons.join(latest, "id", "left")
    seen = F.col("_o").isNotNull()
    new = {
        "name": "name", "address": "full_address", "latitude": "latitude", "longitude": "longitude",
        "description": "description", "organization_id": "organization_id", "branch_id": "branch_id",
        "provider_updated_at": "provider_updated_at",
    }
    updates = {c: F.coalesce(F.col(f"_o._details.{d}"), F.col(c)) for c, d in new.items() if c in salons.columns}
    fresh = F.col("_o._details.categories")
    if "categories" in salons.columns:
        updates["categories"] = F.when(F.size(fresh) > 0, fresh).otherwise(F.col("categories"))
    if "normalized_address" in salons.columns:
        updates["normalized_address"] = F.coalesce(
            normalize_text("_o._details.full_address"), F.col("normalized_address")
        )
    error = F.col("_o.error") if "error" in outcomes.columns else F.lit(None).cast("string")
    updates |= {
        "details_status": F.coalesce("_o.status", "details_status"),
        "details_enriched_at": F.when(seen, as_of).otherwise(F.col("details_enriched_at")),
    }
    if "details_error" in salons.columns:
        success = F.col("_o.status") == "success"
        updates["details_error"] = F.when(seen & ~success, error).when(~seen, F.col("details_error"))
    if "updated_at" in salons.columns:
        updates["updated_at"] = F.when(seen, as_of).otherwise(F.col("updated_at"))
    return joined.withColumns(updates).select(*salons.columns)


def apply_classification(salons: DataFrame, decided: DataFrame, version: str,
                         as_of: Column) -> tuple[DataFrame, DataFrame]:
    """(salon table with the new decisions, audit rows to append). `decided` has id,
    the decision columns and `input_snapshot`."""
    decision = decided.select(
        "id",
        F.struct(
            F.when(F.col("accepted"), "accepted").otherwise("rejected").alias("filter_status"),
            F.col("confidence").alias("filter_confidence"),
            F.col("reason_codes").alias("classifier_reason_codes"),
            "rejection_reason", "business_profile",
            F.col("decision_name").alias("classifier_decision_name"),
            F.col("decision_categories").alias("classifier_decision_categories"),
            F.lit(version).alias("classifier_version"),
            as_of.alias("classified_at"), as_of.alias("updated_at"),
        ).alias("_new"),
    )
    fields = [f.name for f in decision.schema["_new"].dataType.fields]
    joined = salons.join(decision, "id", "left")
    hit = F.col("_new").isNotNull()
    table = joined.withColumns(
        {c: F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in fields if c in salons.columns}
    ).select(*salons.columns)
    audit = decided.select(
        F.col("id").alias("salon_id"), F.lit(version).alias("classifier_version"), "accepted",
        "business_profile", "reason_codes", "rejection_reason", "input_snapshot",
        as_of.alias("classified_at"),
    )
    return table, audit
