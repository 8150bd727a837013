"""Does a priced line offer the target service?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeledger.fixed_values import SERVICE_WORDS
from placeledger.functions.text import contains_any, normalize_text
from placeledger.operators.stage import stage


def match_service(df: DataFrame, name: str, context: str | None = None,
                  words: dict[str, list[str]] = SERVICE_WORDS) -> DataFrame:
    """Add `match`: struct(status, service_name_normalized, confidence, reason_codes).

    The texts are normalised, the word lists are not. So a needle with "-" or "+" never
    hits, and a short needle such as `men` also hits inside longer words. Both are part
    of the rule table's meaning.
    """
    both = F.concat_ws(" ", F.nullif(F.col(name), F.lit("")), *([F.col(context)] if context else []))
    empty = F.lit("")
    texts = stage(
        df,
        _match_text=F.struct(
            F.coalesce(normalize_text(name), empty).alias("service"),
            F.coalesce(normalize_text(both), empty).alias("all"),
        ),
    )
    service, everything = F.col("_match_text.service"), F.col("_match_text.all")

    def has(text: Column, key: str) -> Column:
        return contains_any(text, words[key], normalize=False)

    signals = stage(
        texts,
        _match_signals=F.struct(
            has(everything, "base").alias("base"),
            has(everything, "coating").alias("coating"),
            has(everything, "strong").alias("strong"),
            has(service, "negative").alias("negative"),
            has(service, "men").alias("men"),
            has(service, "package").alias("package"),
            has(service, "unrelated").alias("unrelated"),
        ),
    )
    s = F.col("_match_signals")

    def verdict(status: str, confidence: str, *reasons, named: bool = True) -> Column:
        codes = [F.lit(r) if isinstance(r, str) else r for r in reasons]
        return F.struct(
            F.lit(status).alias("status"),
            (service if named else F.lit(None).cast("string")).alias("service_name_normalized"),
            F.lit(confidence).alias("confidence"),
            F.filter(F.array(*codes), lambda r: r.isNotNull()).alias("reason_codes"),
        )

    both_words = s["base"] & s["coating"]
    rescued = F.when(s["negative"], "mens_manicure_equivalent")
    return stage(
        signals,
        match=F.when(everything == "", verdict("unrelated", "low", "empty_service", named=False))
        .when(s["negative"] & ~(s["men"] & both_words), verdict("excluded", "high", "excluded_service_signal"))
        .when(s["package"], verdict("ambiguous", "low", "package_service_signal"))
        .when(s["strong"] | both_words, verdict("matched", "high", rescued, "manicure_signal", "coating_signal"))
        .when(s["coating"], verdict("ambiguous", "medium", "coating_without_manicure_signal"))
        .when(s["base"], verdict("excluded", "high", "manicure_without_coating_signal"))
        .when(s["unrelated"], verdict("excluded", "high", "unrelated_service"))
        .otherwise(verdict("unrelated", "low", "no_target_signal")),
    ).drop("_match_text", "_match_signals")
