"""Details responses to outcomes, details and contacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeledger.fixed_values import PROVIDER
from placeledger.functions import jsons as J
from placeledger.functions.contacts import normalize_contact
from placeledger.functions.text import blank_to_null
from placeledger.operators.parse_search import address_of, contact_entries, rubric_names
from placeledger.operators.stage import stage


def outcome_status(http_status: Column, body: Column) -> Column:
    """Details outcome from the HTTP status and the payload (NULL body = unreadable)."""
    code = J.get(body, "$.meta.code", "int")
    result, items = J.get(body, "$.result"), J.get(body, "$.result.items")
    first = J.get(body, "$.result.items[0]")
    malformed = ~J.is_object(result) | ~J.is_array(items) | ~J.is_object(first)
    by_http = (
        F.when(http_status == 404, "not_found")
        .when(http_status.isin(401, 403), "unauthorized")
        .when(http_status == 429, "rate_limited")
        .when(http_status.isin(408, 500, 502, 503, 504), "transient_error")
        .otherwise("provider_error")
    )
    return (
        F.when(F.coalesce(http_status, F.lit(0)) >= 400, by_http)
        .when(body.isNull(), "provider_error")
        .when(code == 404, "not_found")
        .when(code.isin(401, 403), "unauthorized")
        .when(code >= 400, "provider_error")
        .when(malformed, "parser_error")
        .otherwise("success")
    )


def parse_details(responses: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Details responses to (details, contacts, outcomes), all narrow.

    Outcomes keep one row per response. Contacts are normalised and unique per
    response by type and normalised value, the first one kept.
    """
    read = stage(responses, _body=J.lenient("body"))
    read = stage(read, status=outcome_status(F.col("http_status"), F.col("_body")))
    outcomes = read.select(
        "id", "salon_id", "external_id", "http_status",
        J.get(F.col("_body"), "$.meta.code", "int").alias("payload_code"),
        "status", F.col("source_url").alias("sanitized_source_url"),
        F.col("body").alias("raw_payload_json"),
    )
    good = stage(
        read.filter(F.col("status") == "success").select("id", "salon_id", "external_id", "_body"),
        item=J.get(F.col("_body"), "$.result.items[0]"),
    )
    item = F.col("item")
    updated = J.first_truthy(J.get(item, "$.updated_at"), J.get(item, "$.last_update"))
    details = good.select(
        "id", "salon_id",
        F.lit(PROVIDER).alias("external_source"),
        "external_id",
        J.text_at(item, "$.name").alias("name"),
        F.coalesce(blank_to_null(J.text_at(item, "$.full_address_name")), address_of(J.get(item, "$.address"), J.get(item, "$.address_name"))).alias("full_address"),
        J.get(item, "$.point.lat", "double").alias("latitude"),
        J.get(item, "$.point.lon", "double").alias("longitude"),
        rubric_names(item).alias("categories"),
        J.text_at(item, "$.description").alias("description"),
        J.text_at(item, "$.schedule").alias("working_hours"),
        J.text_at(item, "$.org").alias("branch_info"),
        J.text_at(item, "$.org.id").alias("organization_id"),
        J.text_at(item, "$.id").alias("branch_id"),
        J.scalar_text(updated).alias("provider_updated_at"),
    )
    contacts = good.select("id", "salon_id", F.explode(detail_contacts(item)).alias("c")).select(
        "id", "salon_id", "c.*"
    )
    return details, contacts, outcomes


def detail_contacts(item: Column, source: str = PROVIDER) -> Column:
    """Array of an item's valid contacts, first of each (type, normalised value).

    A provider item lists a handful of contacts, so uniqueness is settled inside the
    row instead of by a shuffle.
    """
    parsed = F.transform(
        contact_entries(item),
        lambda e: F.struct(normalize_contact(e["type"], e["value"]).alias("n"), e.alias("raw")),
    )
    valid = F.filter(parsed, lambda p: p["n"].isNotNull())
    key = lambda p: F.struct(p["n"]["contact_type"], p["n"]["normalized_value"])
    keys = F.array_distinct(F.transform(valid, key))
    firsts = F.transform(keys, lambda k: F.get(F.filter(valid, lambda p: key(p) == k), F.lit(0)))
    return F.transform(
        firsts,
        lambda p: F.struct(
            p["n"]["contact_type"].alias("contact_type"),
            p["n"]["display_value"].alias("display_value"),
            p["n"]["normalized_value"].alias("normalized_value"),
            F.lit(source).alias("source"),
            F.create_map(
                F.lit("raw_type"), p["raw"]["type"], F.lit("comment"), p["raw"]["comment"]
            ).alias("metadata"),
        ),
    )


def enrichment_counters(outcomes: DataFrame, contacts: DataFrame) -> DataFrame:
    """Counters of one enrichment run: responses by outcome, and what `merge_contacts`
    (its `change` column) made of their contacts. Both are one row, side by side."""
    ok = F.col("status") == "success"
    answered = outcomes.agg(
        F.count("*").alias("processed"), F.count_if(ok).alias("succeeded"),
        F.count_if(F.col("status") == "not_found").alias("not_found"),
        F.count_if(~ok & (F.col("status") != "not_found")).alias("failed"),
    )
    changed = contacts.agg(*[
        F.count_if(F.col("change") == c).alias(f"contacts_{c}") for c in ("created", "updated", "deactivated")])
    return answered.withColumn("_one", F.lit(1)).join(changed.withColumn("_one", F.lit(1)), "_one").drop("_one")
