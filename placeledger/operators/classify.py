"""Rule cascade that accepts or rejects an entity, with its reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from placeledger.fixed_values import ENTITY_WORDS
from placeledger.functions.labels import salon_type
from placeledger.functions.text import contains_any, normalize_text
from placeledger.operators.stage import stage

DECISION_FIELDS = [
    "accepted", "confidence", "reason_codes", "business_profile", "rejection_reason",
    "decision_name", "decision_categories",
]


@dataclass(frozen=True)
class Outcome:
    """One row of the decision table: what holds when its condition is the first hit."""

    condition: Column
    confidence: float
    reasons: tuple[str, ...]
    rejection: str | None = None
    profile: str | Column = "unknown"
    with_signal: bool = True


def _signals(words: dict[str, list[str]]) -> Column:
    """All word-list tests as one struct, so every text is searched once per list."""
    name, categories, description, everything = (
        F.col(f"_text.{n}") for n in ("name", "categories", "description", "all")
    )
    tests = {
        "strong_category": contains_any(categories, words["strong_category"]),
        "allowed": contains_any(categories, words["allowed_category"]),
        "unrelated_category": contains_any(categories, words["unrelated"]),
        "unrelated_name": contains_any(name, words["unrelated"]),
        "nail_name": contains_any(name, words["nail_name"]),
        "nail_description": contains_any(description, words["nail_name"]),
        "beauty_name": contains_any(name, words["beauty_name"]),
        "generic_name": contains_any(name, words["generic_name"]),
        "nail_studio_name": contains_any(name, words["nail_studio_name"]),
        "coworking": contains_any(everything, words["coworking"]),
        "home": contains_any(everything, words["home_master"]),
        "training": contains_any(everything, words["training"]),
        "supply": contains_any(everything, words["supply"]),
    }
    return F.struct(*[test.alias(n) for n, test in tests.items()])


def training_only(s: Column) -> Column:
    """Teaches rather than serves: no allowed category and no salon-like name."""
    named = s["nail_name"] | s["beauty_name"] | s["generic_name"]
    return s["training"] & ~s["allowed"] & ~named


def supply_only(s: Column) -> Column:
    """Sells supplies; a nail name does not outweigh that."""
    return s["supply"] & ~s["allowed"] & ~(s["beauty_name"] | s["generic_name"])


def _decision_table(s: Column) -> list[Outcome]:
    base = s["strong_category"] | s["nail_name"] | s["nail_description"]
    salon_name = s["beauty_name"] | s["generic_name"]
    by_studio_name = F.when(s["nail_studio_name"], "nail_specialist").otherwise("mixed_beauty_salon")
    return [
        Outcome(s["coworking"], 0.95, ("coworking_or_rental_signal",), "coworking_or_rental", with_signal=False),
        Outcome(s["home"], 0.9, ("home_or_private_master_signal",), "home_or_private_master", with_signal=False),
        Outcome(~base, 0.75, ("no_manicure_signal",), "no_manicure_signal", with_signal=False),
        Outcome(
            s["unrelated_name"] & s["unrelated_category"] & ~s["beauty_name"] & ~s["nail_name"], 0.9,
            ("unrelated_primary_name_signal", "unrelated_primary_category_signal"),
            "mixed_non_salon", "mixed_non_salon",
        ),
        Outcome(training_only(s), 0.85, ("training_only_signal",), "training_only"),
        Outcome(
            supply_only(s), 0.85, ("beauty_supply_without_service_signal",), "beauty_supply_without_service"
        ),
        Outcome(s["nail_name"], 0.92, ("nail_name_signal",), profile="nail_specialist"),
        Outcome(salon_name, 0.88, ("salon_or_studio_name_signal",), profile=by_studio_name),
        Outcome(
            s["allowed"] & ~s["unrelated_category"], 0.82, ("allowed_beauty_category_signal",),
            profile="mixed_beauty_salon",
        ),
        Outcome(
            s["allowed"], 0.72, ("allowed_beauty_category_signal", "unrelated_primary_category_signal"),
            "mixed_non_salon", "mixed_non_salon",
        ),
        Outcome(s["strong_category"], 0.78, ("strong_manicure_category_signal",), profile="nail_specialist"),
        Outcome(F.lit(True), 0.65, ("no_salon_or_studio_signal",), "no_salon_or_studio_signal"),
    ]


def _as_struct(outcome: Outcome) -> Column:
    reasons = (("manicure_signal",) if outcome.with_signal else ()) + outcome.reasons
    profile = F.lit(outcome.profile) if isinstance(outcome.profile, str) else outcome.profile
    return F.struct(
        F.lit(outcome.rejection is None).alias("accepted"),
        F.lit(outcome.confidence).alias("confidence"),
        F.array(*[F.lit(r) for r in reasons]).alias("reason_codes"),
        profile.alias("business_profile"),
        F.lit(outcome.rejection).cast("string").alias("rejection_reason"),
    )


def classify_entities(
    df: DataFrame,
    words: dict[str, list[str]] = ENTITY_WORDS,
    name: str = "name",
    categories: str = "categories",
    description: str = "description",
    address: str = "address",
) -> DataFrame:
    """Add the decision columns (`DECISION_FIELDS`) to every row.

    Texts, word tests and the decision are separate stages, so each text is normalised
    once and each word list searched once per row, however many rules mention it.
    """
    texts = stage(
        df,
        _norm=F.struct(
            normalize_text(name).alias("name"),
            normalize_text(F.array_join(categories, " ")).alias("categories"),
            normalize_text(description).alias("description"),
            normalize_text(address).alias("address"),
        ),
    )
    parts = [F.col(f"_norm.{n}") for n in ("name", "categories", "description", "address")]
    texts = stage(
        texts,
        _text=F.struct(
            *[F.coalesce(p, F.lit("")).alias(n) for p, n in zip(parts, ("name", "categories", "description"))],
            F.concat_ws(" ", *parts).alias("all"),
        ),
    )
    signals = stage(texts, _signals=_signals(words))
    chain = None
    for outcome in _decision_table(F.col("_signals")):
        value = _as_struct(outcome)
        chain = F.when(outcome.condition, value) if chain is None else chain.when(outcome.condition, value)
    decided = stage(signals, _decision=chain)
    kept = [c for c in df.columns if c not in DECISION_FIELDS]
    return decided.select(
        *kept,
        *[F.col(f"_decision.{n}").alias(n) for n in DECISION_FIELDS[:5]],
        F.col(name).alias("decision_name"),
        F.col(categories).alias("decision_categories"),
    )


def decision_columns(df: DataFrame) -> DataFrame:
    """Decision columns renamed to the current-state layout of a salon row."""
    return df.withColumns(
        {
            "filter_status": F.when(F.col("accepted"), "accepted").otherwise("rejected"),
            "filter_confidence": F.col("confidence"),
            "classifier_reason_codes": F.col("reason_codes"),
            "classifier_decision_name": F.col("decision_name"),
            "classifier_decision_categories": F.col("decision_categories"),
            "salon_type": salon_type("business_profile"),
        }
    ).drop("accepted", "confidence", "reason_codes", "decision_name", "decision_categories")
