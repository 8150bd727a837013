"""Best-supported price of the target service per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from placeledger.fixed_values import (
    NO_PRICE_EVIDENCE,
    PAYLOADS_PER_SALON,
    PRICE_PARSER_VERSION,
    SERVICE_WORDS,
    TARGET_SERVICE,
)
from placeledger.functions.prices import PRICE_TYPE, price_of_number, price_of_text
from placeledger.operators.eligibility import accepted_or_unset
from placeledger.operators.evidence import page_evidence, structured_evidence
from placeledger.operators.service import match_service
from placeledger.operators.stage import stage



def latest_payloads(details: DataFrame, n: int = PAYLOADS_PER_SALON) -> DataFrame:
    """The last `n` successful payloads of every salon, newest first (`page` 1..n).

    Validity is judged later, so an unreadable payload uses up one of the n places.
    The rank limit also applies before the shuffle.
    """
    newest = W.partitionBy("salon_id").orderBy(F.desc("id"))
    return (
        details.filter(F.col("status") == "success")
        .withColumn("page", F.row_number().over(newest))
        .filter(F.col("page") <= n)
        .select(
            "id", "salon_id", "page", F.col("raw_payload_json").alias("payload"),
            F.col("sanitized_source_url").alias("source_url"),
        )
    )


def judge_evidence(evidence: DataFrame, words: dict[str, list[str]] = SERVICE_WORDS) -> DataFrame:
    """Evidence that speaks for the service, with `verdict` and `price`.

    `found` needs a clear match and a readable price, anything less is `ambiguous`.
    A price given as a JSON container cannot be read at all and is an `error`.
    """
    matched = match_service(evidence, "service_name_raw", "evidence_text", words)
    relevant = matched.filter(F.col("match.status").isin("matched", "ambiguous"))
    price = F.when(
        F.col("price_kind").isin("number", "boolean"), price_of_number("price_number")
    ).when(F.col("price_kind") == "string", price_of_text("price_text"))
    priced = stage(relevant, price=price.cast(PRICE_TYPE))
    verdict = (
        F.when(F.col("price_kind") == "container", "error")
        .when((F.col("match.status") == "ambiguous") | F.col("price").isNull(), "ambiguous")
        .otherwise("found")
    )
    return stage(priced, verdict=verdict).withColumn(
        "price", F.when(F.col("verdict") == "found", F.col("price"))
    )


_CANDIDATE = (
    "verdict", "service_name_raw", "source_type", "source_url", "evidence_text", "match", "price",
)


def best_evidence(judged: DataFrame, *by: str) -> DataFrame:
    """First decisive evidence per group in reading order, else the first ambiguous one.

    A plain aggregate: every task first reduces its own rows to one per group, so a
    group with any number of lines costs one row per task in the shuffle.
    """
    weight = F.struct((F.col("verdict") == "ambiguous").alias("weak"), F.col("place"))
    return judged.groupBy(*by).agg(F.min_by(F.struct(*_CANDIDATE), weight).alias("best"))


def extract_prices(salons: DataFrame, details: DataFrame, pages: DataFrame, as_of: Column,
                   words: dict[str, list[str]] = SERVICE_WORDS) -> DataFrame:
    """One result row per accepted-or-unset salon.

    Order of preference: a provider price, then whatever the website gives, then an
    ambiguous provider row. A failed page fetch makes the result an error unless the
    provider already settled it. Page text is judged where it is read: only matching
    lines, reduced to one per task and salon, go through the shuffle.
    """
    provider = judge_evidence(structured_evidence(latest_payloads(details)), words)
    fetched = pages.filter(F.col("fetch_error").isNull())
    website = judge_evidence(page_evidence(fetched), words)
    errors = pages.filter(F.col("fetch_error").isNotNull())

    weight = F.struct((F.col("verdict") == "ambiguous").alias("weak"), F.col("place"))
    candidates = [
        side.select("salon_id", F.lit(name).alias("side"), weight.alias("weight"), F.struct(*_CANDIDATE).alias("best"))
        for name, side in (("provider", provider), ("website", website))
    ]
    flags = salons.filter(accepted_or_unset()).select(
        F.col("id").alias("salon_id"), F.lit("salon").alias("side"),
        (F.coalesce("website", F.lit("")) != "").alias("has_website"),
    )
    # A list of pages is read in order; the first failure is the one reported.
    failures = errors.select(
        "salon_id", F.lit("error").alias("side"), F.col("fetch_error").alias("error"), "page_no"
    )
    rows = candidates[0].unionByName(candidates[1]).unionByName(flags, True).unionByName(failures, True)

    def of(side: str, aggregate: str) -> Column:
        return F.expr(f"{aggregate} FILTER (WHERE side = '{side}')")

    grouped = rows.groupBy("salon_id").agg(
        of("provider", "min_by(best, weight)").alias("provider"),
        of("website", "min_by(best, weight)").alias("website"),
        of("salon", "max(has_website)").alias("has_website"),
        of("error", "min_by(error, page_no)").alias("fetch_error"),
    ).filter("has_website IS NOT NULL")

    site = F.col("has_website")
    settled = F.coalesce(F.col("provider.verdict").isin("found", "error"), F.lit(False))
    failed = ~settled & site & F.col("fetch_error").isNotNull()
    pick = (
        F.when(settled, F.col("provider"))
        .when(failed, F.lit(None))
        .when(site & F.col("website").isNotNull(), F.col("website"))
        .otherwise(F.col("provider"))
    )
    picked = stage(stage(grouped, failed=failed, pick=pick), extraction_status=(
        F.when(F.col("failed"), "error").otherwise(F.coalesce("pick.verdict", F.lit("not_found")))
    ))
    return _result_columns(picked, as_of)


def _result_columns(picked: DataFrame, as_of: Column) -> DataFrame:
    status, pick = F.col("extraction_status"), F.col("pick")
    has_price = status.isin("found", "ambiguous")
    kept = lambda c: F.when(has_price, c)
    return picked.select(
        "salon_id",
        F.lit(TARGET_SERVICE).alias("service_key"),
        "extraction_status",
        kept(pick["service_name_raw"]).alias("service_name_raw"),
        kept(pick["match"]["service_name_normalized"]).alias("service_name_normalized"),
        kept(pick["price"]["amount_minor"]).alias("amount_minor"),
        kept(pick["price"]["currency"]).alias("currency"),
        F.when(status == "found", pick["price"]["price_type"])
        .when(status == "ambiguous", "ambiguous").otherwise("not_found").alias("price_type"),
        kept(pick["price"]["range_min_minor"]).alias("range_min_minor"),
        kept(pick["price"]["range_max_minor"]).alias("range_max_minor"),
        F.when(has_price, pick["source_type"]).when(status == "not_found", "none").alias("source_type"),
        kept(pick["source_url"]).alias("source_url"),
        F.when(has_price, pick["evidence_text"]).when(status == "not_found", NO_PRICE_EVIDENCE)
        .alias("evidence_text"),
        F.when(has_price, pick["match"]["confidence"]).otherwise("low").alias("confidence"),
        as_of.alias("checked_at"),
        F.lit(PRICE_PARSER_VERSION).alias("parser_version"),
        F.when(status == "error", F.coalesce("fetch_error", F.lit("price is not a scalar"))).alias("error_message"),
    )


def pricing_counters(results: DataFrame) -> DataFrame:
    """Counters of one price run."""
    def of(status: str, name: str) -> Column:
        return F.count_if(F.col("extraction_status") == status).alias(name)

    return results.agg(
        F.count("*").alias("processed"), of("found", "found"), of("ambiguous", "ambiguous"),
        of("error", "errors"), of("not_found", "not_found"),
    )
