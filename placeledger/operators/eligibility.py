"""Which rows are due for which step, and in which order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeledger.fixed_values import PROVIDER


def accepted_or_unset() -> Column:
    """Rows without a status count as accepted for work, never for reports."""
    return F.coalesce(F.col("filter_status"), F.lit("accepted")) == "accepted"


def enrichable(provider: str = PROVIDER) -> Column:
    source = F.lower(F.coalesce("external_source", "source", F.lit("")))
    return (source == provider.lower()) & (F.trim("external_id") != "") & accepted_or_unset()


def due_for_enrichment(salons: DataFrame, as_of: Column | None = None, days: int | None = None,
                       n: int | None = None, provider: str = PROVIDER) -> DataFrame:
    """Enrichable rows never enriched, last unsuccessful, or older than `days` at `as_of`."""
    stale = F.col("details_enriched_at").isNull() | ~F.col("details_status").eqNullSafe("success")
    if days is not None:
        stale = stale | (F.col("details_enriched_at") <= as_of - F.expr(f"INTERVAL {int(days)} DAYS"))
    return _first(salons.filter(enrichable(provider) & stale), n, "id")


def due_for_pricing(salons: DataFrame, n: int | None = None) -> DataFrame:
    """Accepted-or-unset rows, unchecked ones first."""
    checked = F.when(F.col("verification_status") == "not_checked", 0).otherwise(1)
    return _first(salons.filter(accepted_or_unset()), n, checked, "id")


def due_for_reclassification(salons: DataFrame, version: str | None = None, n: int | None = None,
                             salon_id: int | None = None) -> DataFrame:
    """Rows by id; with `version`, only those not classified by it."""
    rows = salons if salon_id is None else salons.filter(F.col("id") == salon_id)
    if version is not None:
        rows = rows.filter(~F.col("classifier_version").eqNullSafe(version))
    return _first(rows, n, "id")


def next_regions(regions: DataFrame, n: int | None = None) -> DataFrame:
    """Open regions: those in progress first, then by scan order."""
    started = F.when(F.col("status") == "in_progress", 0).otherwise(1)
    return _first(regions.filter(F.col("status").isin("in_progress", "pending")), n, started, "scan_order")


def _first(df: DataFrame, n: int | None, *order) -> DataFrame:
    """The first `n` rows in order: each task keeps n rows, no global sort. Without a
    limit the rows come back as they are, so no sort is paid for."""
    return df if n is None else df.orderBy(*order).limit(n)


def pricing_eligible(salons: DataFrame, contacts: DataFrame, details: DataFrame) -> DataFrame:
    """Accepted rows that have a website of their own, an active website contact or a
    successful details result. The other sides only answer yes or no, so both are
    semi joins and no row multiplies. They are made distinct first: the map-side combine
    shrinks a salon with very many contacts, and the join reuses the partitioning."""
    accepted = salons.filter(F.col("filter_status") == "accepted")
    own = accepted.filter(F.col("website").isNotNull())
    rest = accepted.filter(F.col("website").isNull())
    sources = (
        contacts.filter(F.col("is_active") & (F.col("contact_type") == "website")).select("salon_id")
        .unionByName(details.filter(F.col("status") == "success").select("salon_id"))
    ).distinct().withColumnRenamed("salon_id", "id")
    return own.unionByName(rest.join(sources, "id", "left_semi"))
