"""Report datasets over the current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeledger.fixed_values import (
    COMMENT_BY_PRICE_STATUS,
    COMMENT_DETAILS_OK,
    COMMENT_FOUND,
    COMMENT_NO_CONTACTS,
    COMMENT_NO_CONTACTS_OK,
    TARGET_SERVICE,
)
from placeledger.functions.labels import profile_label
from placeledger.functions.prices import display_price_report
from placeledger.functions.text import strip
from placeledger.functions.times import latest, parse_datetime

PRICED = ("exact", "from", "range")


def contact_rows(contacts: DataFrame) -> DataFrame:
    """One row per distinct active contact value: salon_id, list (phones, links or NULL),
    value and place, by which a salon's values are ordered. The unbounded form of the
    lists, for exports that do not need a salon in one row."""
    active = contacts.filter("is_active").select("salon_id", "contact_type", "id", strip("display_value").alias("value"))
    listed = F.when(F.col("contact_type") == "phone", "phones").when(
        F.col("contact_type").isin("website", "social"), "links"
    )
    return active.withColumn("list", listed).groupBy("salon_id", "list", "value").agg(
        F.min(F.struct("contact_type", "id")).alias("place")
    )


def contact_lists(contacts: DataFrame) -> DataFrame:
    """Per salon its active phones and links (distinct, by type and arrival) and
    whether it has any active contact.

    Equal values fold into one row before lists are built, so a list is as long as
    the distinct values the report shows, not as the contact history.
    """

    def values(name: str) -> Column:
        wanted = (F.col("list") == name) & (F.col("value") != "")
        rows = F.array_sort(F.collect_list(F.when(wanted, F.struct("place", "value"))))
        return F.transform(rows, lambda r: r["value"]).alias(name)

    return contact_rows(contacts).groupBy("salon_id").agg(values("phones"), values("links"), F.lit(True).alias("has_contact"))


def newest_prices(prices: DataFrame, service: str = TARGET_SERVICE) -> DataFrame:
    """Newest active price of the service per salon."""
    columns = [
        "price_type", "amount_minor", "currency", "range_min_minor", "range_max_minor",
        "service_name_raw", "source_type", "source_url",
    ]
    active = prices.filter(F.col("is_active") & (F.col("service_key") == service))
    # Rows without an id count as older than any with one, and still count.
    return active.groupBy("salon_id").agg(
        F.max_by(F.struct(*columns), F.struct(F.col("id").isNotNull(), F.col("id"))).alias("price"))


def _in_region(df: DataFrame, region_id: int | None, column: str = "region_id") -> DataFrame:
    return df if region_id is None else df.filter(F.col(column) == region_id)


def _with_region(salons: DataFrame, regions: DataFrame) -> DataFrame:
    names = regions.select(F.col("id").alias("region_id"), F.col("name").alias("region"), "scan_order")
    return salons.join(names, "region_id")


def price_status(verification: Column, price_type: Column) -> Column:
    return F.coalesce(
        price_type,
        F.when(verification.isin("not_found", "ambiguous", "error"), verification),
        F.lit("not_checked"),
    )


def comment(details_status: Column, has_contact: Column, status: Column) -> Column:
    """Fixed fragments in order; concat_ws leaves out the ones that do not apply."""
    checked = F.coalesce(details_status == "success", F.lit(False))
    by_status = F.coalesce(*[F.when(status == s, text) for s, text in COMMENT_BY_PRICE_STATUS.items()])
    return F.concat(
        F.concat_ws(
            "; ",
            F.lit(COMMENT_FOUND),
            F.when(checked, COMMENT_DETAILS_OK),
            F.when(~has_contact, F.when(checked, COMMENT_NO_CONTACTS_OK).otherwise(COMMENT_NO_CONTACTS)),
            by_status,
        ),
        F.lit("."),
    )


def accepted_report(salons: DataFrame, regions: DataFrame, contacts: DataFrame, prices: DataFrame,
                    region_id: int | None = None) -> DataFrame:
    """One row per accepted salon. Contacts and prices are reduced to one row per salon
    before they are joined, so nothing multiplies."""
    accepted = _in_region(salons.filter(F.col("filter_status") == "accepted"), region_id)
    none = F.array().cast("array<string>")
    joined = (
        _with_region(accepted, regions)
        .join(contact_lists(contacts).withColumnRenamed("salon_id", "id"), "id", "left")
        .join(newest_prices(prices).withColumnRenamed("salon_id", "id"), "id", "left")
    )
    p = F.col("price")
    status = price_status(F.col("verification_status"), p["price_type"])
    return joined.withColumn("price_status", status).select(
        "id", "scan_order", "region", "city", "name", "address",
        F.coalesce("phones", none).alias("phones"),
        F.coalesce("links", none).alias("links"),
        display_price_report(
            p["price_type"], p["amount_minor"], p["range_min_minor"], p["range_max_minor"]
        ).alias("price"),
        p["currency"].alias("currency"),
        F.coalesce(p["price_type"], F.lit("not_checked")).alias("price_type"),
        p["service_name_raw"].alias("service_name"),
        p["source_type"].alias("price_source"),
        "price_status",
        "masters_count",
        F.coalesce(F.nullif("business_profile", F.lit("")), F.lit("unknown")).alias("business_profile"),
        profile_label("business_profile").alias("profile_label"),
        "verification_status",
        comment(F.col("details_status"), F.coalesce("has_contact", F.lit(False)), F.col("price_status")).alias("comment"),
        F.coalesce(F.nullif("external_source", F.lit("")), F.col("source")).alias("external_source"),
        "external_id",
        F.coalesce(parse_datetime("first_seen_at"), parse_datetime("created_at")).alias("first_seen_at"),
        latest("details_enriched_at", "last_seen_at", "updated_at").alias("last_checked_at"),
        "classifier_version",
    )


def excluded_report(salons: DataFrame, regions: DataFrame, region_id: int | None = None) -> DataFrame:
    """One row per rejected salon with the reasons of its decision."""
    rejected = _in_region(salons.filter(F.col("filter_status") == "rejected"), region_id)
    return _with_region(rejected, regions).select(
        "id", "scan_order", "region", "name", "address", "rejection_reason", "business_profile",
        F.col("classifier_reason_codes").alias("reason_codes"), "external_id", "classifier_version",
        parse_datetime("classified_at").alias("classified_at"),
    )


def in_report_order(report: DataFrame) -> DataFrame:
    """Rows by region order, name and id, range-partitioned for a sorted output."""
    return report.orderBy("scan_order", "name", "id").drop("scan_order")


def region_summary(regions: DataFrame, salons: DataFrame, contacts: DataFrame, prices: DataFrame,
                   region_id: int | None = None, service: str = TARGET_SERVICE) -> DataFrame:
    """Per region: accepted, rejected, accepted with any active contact, accepted with a
    usable active price. All regions appear."""
    reached = contacts.filter("is_active").select(F.col("salon_id").alias("id")).distinct().withColumn("_c", F.lit(True))
    usable = F.col("is_active") & (F.col("service_key") == service) & F.col("price_type").isin(*PRICED)
    priced = prices.filter(usable).select(F.col("salon_id").alias("id")).distinct().withColumn("_p", F.lit(True))
    status = F.col("filter_status")
    counted = (
        _in_region(salons, region_id).select("id", "region_id", "filter_status")
        .join(reached, "id", "left").join(priced, "id", "left")
        .groupBy("region_id").agg(
            F.count_if(status == "accepted").alias("accepted"),
            F.count_if(status == "rejected").alias("rejected"),
            F.count_if((status == "accepted") & F.col("_c")).alias("with_contacts"),
            F.count_if((status == "accepted") & F.col("_p")).alias("with_prices"),
        )
    )
    zero = F.lit(0).cast("bigint")
    return _in_region(regions, region_id, "id").join(counted.withColumnRenamed("region_id", "id"), "id", "left").select(
        "id", "scan_order", F.col("name").alias("region"),
        *[F.coalesce(c, zero).alias(c) for c in ("accepted", "rejected", "with_contacts", "with_prices")],
        F.col("status").alias("last_scan_status"),
    )


def report_metrics(accepted: DataFrame, excluded: DataFrame, regions: DataFrame, grids: DataFrame,
                   as_of: str, store: str, version: str) -> DataFrame:
    """The report's metric and value rows. "With contacts" means phones or links here,
    and "with price" looks at the newest active price only. Each count is an aggregate
    of its own table; the one-row results are stacked, not joined."""
    has_phone, has_link = F.size("phones") > 0, F.size("links") > 0
    priced = F.col("price_type").isin(*PRICED)

    def stacked(df: DataFrame, **counts: Column) -> DataFrame:
        row = df.agg(*[c.cast("string").alias(n) for n, c in counts.items()])
        return row.unpivot([], list(counts), "metric", "value")

    spark = accepted.sparkSession
    fixed = spark.createDataFrame(
        [
            ("export_timestamp", as_of), ("database_path", store),
            ("current_classifier_version", version), ("workbook_generation_status", "complete"),
        ],
        "metric string, value string",
    )
    return (
        fixed.unionByName(stacked(regions, total_regions=F.count("*")))
        .unionByName(stacked(grids, regions_with_generated_grids=F.count_if(F.col("status") == "complete")))
        .unionByName(stacked(excluded, rejected_salon_count=F.count("*")))
        .unionByName(
            stacked(
                accepted,
                accepted_salon_count=F.count("*"),
                accepted_salons_with_phones=F.count_if(has_phone),
                accepted_salons_with_websites_socials=F.count_if(has_link),
                accepted_salons_with_active_target_price=F.count_if(priced),
                accepted_salons_without_contacts=F.count_if(~(has_phone | has_link)),
                accepted_salons_without_prices=F.count_if(~priced),
            )
        )
    )


def export_datasets(salons: DataFrame, regions: DataFrame, contacts: DataFrame, prices: DataFrame,
                    grids: DataFrame, as_of: str, store: str, version: str,
                    region_id: int | None = None) -> dict[str, DataFrame]:
    """The report's datasets: accepted, report, regions and excluded."""
    accepted = accepted_report(salons, regions, contacts, prices, region_id)
    excluded = excluded_report(salons, regions, region_id)
    return {
        "accepted": in_report_order(accepted),
        "report": report_metrics(accepted, excluded, regions, grids, as_of, store, version),
        "regions": region_summary(regions, salons, contacts, prices, region_id).orderBy("scan_order"),
        "excluded": in_report_order(excluded),
    }
