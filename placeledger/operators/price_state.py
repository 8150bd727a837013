"""Current prices of entities, and the price summary on the entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeledger.functions.prices import display_price, whole_units
from placeledger.operators.joins import lookup
from placeledger.operators.numbering import oldest_first, with_ids

_REFRESHED = (
    "service_name_raw", "service_name_normalized", "amount_minor", "currency", "price_type",
    "range_min_minor", "range_max_minor", "source_url", "confidence",
)


def merge_prices(current: DataFrame, results: DataFrame, as_of: Column) -> DataFrame:
    """Price table after a run, with `change` per row.

    `results` has one row per salon and service. A found or ambiguous result makes its
    own evidence the only active row, any other result leaves none active. Missing
    source types and evidence compare as empty texts. New rows get the next ids, by salon,
    service and evidence; that numbering runs when this is called.
    """
    key = ["salon_id", "service_key", "_source", "_evidence"]
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    keyed = {"_source": blank("source_type"), "_evidence": blank("evidence_text")}
    stored = [c for c in current.columns if c not in ("salon_id", "service_key")]
    old = current.withColumns(keyed).select(*key, F.struct(*stored).alias("old"))
    usable = results.filter(F.col("extraction_status").isin("found", "ambiguous")).withColumns(keyed)
    fresh = [c for c in (*_REFRESHED, "source_type", "evidence_text") if c in results.columns]
    new = usable.select(*key, F.struct(*fresh).alias("new"))
    paired = old.unionByName(new, allowMissingColumns=True).groupBy(*key).agg(
        # Several old rows on one key (NULL and '' evidence) fold into the oldest.
        F.min_by("old", F.when(F.col("old").isNotNull(), oldest_first("old.", stored))).alias("old"),
        F.expr("any_value(new) FILTER (WHERE new IS NOT NULL)").alias("new"),
    )
    checked = results.select("salon_id", "service_key", F.lit(True).alias("_checked"))
    state = lookup(paired, checked, ["salon_id", "service_key"], "left")
    seen, known = F.col("new").isNotNull(), F.col("old").isNotNull()
    gone = ~seen & F.coalesce("_checked", F.lit(False)) & F.col("old.is_active")
    state = state.withColumn(
        "change",
        F.when(seen & ~known, "created").when(seen, "updated").when(gone, "deactivated").otherwise("unchanged"),
    )

    def value(c: str) -> Column:
        if c == "is_active":
            return F.when(seen, True).when(gone, False).otherwise(F.col("old.is_active"))
        if c == "first_seen_at":
            return F.coalesce(F.col("old.first_seen_at"), as_of)
        if c == "last_seen_at":
            return F.when(F.col("change") != "unchanged", as_of).otherwise(F.col("old.last_seen_at"))
        if c == "evidence_text":
            return F.when(known, F.col("old.evidence_text")).otherwise(F.coalesce("new.evidence_text", F.lit("")))
        if c == "source_type":
            return F.when(known, F.col("old.source_type")).otherwise(F.col("new.source_type"))
        if c in fresh:
            return F.when(seen, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
        return F.col(f"old.{c}")

    table = state.select(
        "salon_id", "service_key", *[value(c).alias(c) for c in stored], "change"
    ).select(*current.columns, "change")
    return with_ids(table, current, "salon_id", "service_key", "source_type", "evidence_text") if "id" in stored else table


def summarize_prices(salons: DataFrame, results: DataFrame, as_of: Column) -> DataFrame:
    """Salon table with the price summary of its latest result. Only a found price
    replaces the summary; any other outcome changes the verification status alone."""
    single, low, high = whole_units("amount_minor"), whole_units("range_min_minor"), whole_units("range_max_minor")
    is_range = F.col("price_type") == "range"
    fresh = results.select(
        F.col("salon_id").alias("id"),
        F.col("extraction_status").alias("_status"),
        F.struct(
            F.col("service_name_raw").alias("service_name"),
            display_price("price_type", "amount_minor", "range_min_minor", "range_max_minor").alias("service_price"),
            F.when(is_range, low).otherwise(single).alias("price_min"),
            F.when(is_range, high).otherwise(single).alias("price_max"),
            F.col("source_type").alias("price_source"),
            F.col("source_url").alias("price_source_url"),
        ).alias("_price"),
    )
    joined = salons.join(fresh, "id", "left")
    found = F.coalesce(F.col("_status") == "found", F.lit(False))
    fields = ("service_name", "service_price", "price_min", "price_max", "price_source", "price_source_url")
    updates = {c: F.when(found, F.col(f"_price.{c}")).otherwise(F.col(c)) for c in fields if c in salons.columns}
    updates["verification_status"] = F.when(found, "price_found").otherwise(
        F.coalesce("_status", "verification_status")
    )
    if "updated_at" in salons.columns:
        updates["updated_at"] = F.when(F.col("_status").isNotNull(), as_of).otherwise(F.col("updated_at"))
    return joined.withColumns(updates).select(*salons.columns)
