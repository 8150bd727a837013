"""Field-wise merge of sightings into canonical records."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from placeledger.operators.classify import classify_entities, decision_columns
from placeledger.operators.identity import match_existing, resolve_batch, with_identity_texts
from placeledger.operators.joins import lookup
from placeledger.operators.numbering import number_rows
from placeledger.session import cut_lineage


@dataclass(frozen=True)
class MergePolicy:
    """How each column of a record takes the values of its sightings, by arrival."""

    keep_first: list[str] = field(default_factory=list)
    last_non_null: list[str] = field(default_factory=list)
    last_value: list[str] = field(default_factory=list)
    untouched: list[str] = field(default_factory=list)


SALON_POLICY = MergePolicy(
    keep_first=["region_id", "grid_cell_id", "external_id", "first_seen_at"],
    last_non_null=[
        "address", "normalized_address", "latitude", "longitude", "phone", "website",
        "description", "source_url",
    ],
    last_value=[
        "source", "external_source", "name", "normalized_name", "social_links", "categories",
        "salon_type", "filter_status", "filter_confidence", "classifier_reason_codes",
        "rejection_reason", "business_profile", "classifier_decision_name",
        "classifier_decision_categories", "raw_payload", "last_seen_at", "updated_at",
    ],
)


def merge_entities(rows: DataFrame, policy: MergePolicy, key: str = "entity_id", seq: str = "seq") -> DataFrame:
    """One record per entity from all its rows, current state included as the row with
    the lowest `seq`.

    The whole row-by-row update loop becomes one aggregate, hence one shuffle, with
    each task first folding its own rows of an entity.
    """
    def quoted(c: str) -> str:
        return f"`{c}`"

    first = [
        F.expr(f"min_by({quoted(c)}, {quoted(seq)}) FILTER (WHERE {quoted(c)} IS NOT NULL)").alias(c)
        for c in policy.keep_first
    ]
    last = [
        F.expr(f"max_by({quoted(c)}, {quoted(seq)}) FILTER (WHERE {quoted(c)} IS NOT NULL)").alias(c)
        for c in policy.last_non_null
    ]
    # NULL is a value here: the struct around the columns keeps it.
    newest = [F.max_by(F.struct(*policy.last_value), seq).alias("_newest")] if policy.last_value else []
    oldest = [F.min_by(F.struct(*policy.untouched), seq).alias("_oldest")] if policy.untouched else []
    merged = rows.groupBy(key).agg(
        *first, *last, *newest, *oldest, F.count("*").alias("n_rows"),
    )
    spread = [c for c in merged.columns if not c.startswith("_")]
    spread += ["_newest.*"] if newest else []
    spread += ["_oldest.*"] if oldest else []
    return merged.select(*spread)


# Order of sightings that no caller has numbered; equal rows of it are numbered by chance.
ARRIVAL = ("fetched_at", "discovered_grid_cell_id", "discovered_query", "page", "item_pos", "external_id", "raw_payload")


def canonical_candidates(decided: DataFrame) -> DataFrame:
    """Sightings that get a canonical record: accepted, or known by an external id.
    The others stay in the history only."""
    return decided.filter(F.col("accepted") | (F.coalesce("external_id", F.lit("")) != ""))


def assign_entities(obs: DataFrame, current: DataFrame) -> DataFrame:
    """Entity of every sighting: seq, entity_id, known.

    The batch is grouped first; a group belongs to the known entity its earliest
    matched sighting hits, otherwise it is new and named by the lowest free number:
    new ids follow the known ones in arrival order of the groups' first sightings.
    """
    groups = resolve_batch(obs)
    hits = match_existing(obs, current).filter("entity_id IS NOT NULL")
    of_group = groups.join(hits, "seq", "left").groupBy("component").agg(
        F.min_by("entity_id", F.when(F.col("entity_id").isNotNull(), F.col("seq"))).alias("known_id")
    )
    top = current.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).first()["top"]
    of_group = cut_lineage(of_group)
    known = of_group.filter("known_id IS NOT NULL").select("component", F.col("known_id").alias("entity_id"), F.lit(True).alias("known"))
    # `component` is the first sighting's seq: unique and in arrival order already.
    fresh = number_rows(of_group.filter("known_id IS NULL").select("component"), "entity_id", "component", start=int(top) + 1)
    named = known.unionByName(fresh.select("component", "entity_id", F.lit(False).alias("known")))
    return lookup(groups, named, "component").select("seq", "entity_id", "known")


def merge_sightings(current: DataFrame, sightings: DataFrame, as_of, words=None) -> tuple[DataFrame, DataFrame]:
    """Classify a batch and merge it into the current table: (new table, decided).

    Sightings without `seq` are numbered by arrival: fetch time, then request, then the
    item's place in its response. The grouping and the numbering run when this is called.

    `decided` is the batch with its decision, entity (NULL for history-only rows) and
    `merged`, ready to be appended as discovery history.
    """
    # Written once to the shared folder: the batch is read by the grouping rounds, the
    # matching and the merge, and none of them should parse and classify it again.
    classified = classify_entities(with_identity_texts(sightings), **({"words": words} if words else {}))
    if "seq" in sightings.columns:
        decided = cut_lineage(classified)
    else:
        decided = number_rows(classified, "seq", *[c for c in ARRIVAL if c in classified.columns])
    candidates = canonical_candidates(decided)
    entities = cut_lineage(assign_entities(candidates, current))
    # Whoever arrives first at a new entity creates it, every other one merges.
    located = decided.join(entities, "seq", "left")
    creators = located.filter(~F.col("known")).groupBy("entity_id").agg(F.min("seq").alias("_creator"))
    located = lookup(located, creators, "entity_id", "left").withColumn(
        "merged", F.coalesce(F.col("known") | (F.col("seq") > F.col("_creator")), F.lit(False))
    ).drop("_creator")

    incoming = decision_columns(located.filter("entity_id IS NOT NULL")).select(
        "entity_id", "seq", "region_id",
        F.col("discovered_grid_cell_id").alias("grid_cell_id"),
        "external_id", "external_source", F.col("external_source").alias("source"),
        "name", "normalized_name", "address", "normalized_address", "latitude", "longitude",
        F.col("normalized_phone").alias("phone"), "website", "social_links", "categories",
        "description", "source_url", "raw_payload", "salon_type", "filter_status",
        "filter_confidence", "classifier_reason_codes", "rejection_reason", "business_profile",
        "classifier_decision_name", "classifier_decision_categories",
        F.coalesce("fetched_at", as_of).alias("first_seen_at"),
        F.coalesce("fetched_at", as_of).alias("last_seen_at"),
        as_of.alias("updated_at"),
        F.lit("not_checked").alias("verification_status"),
    )
    stored = current.withColumnRenamed("id", "entity_id").withColumn("seq", F.lit(-1).cast("bigint"))
    policy = MergePolicy(
        SALON_POLICY.keep_first, SALON_POLICY.last_non_null, SALON_POLICY.last_value,
        [c for c in stored.columns
         if c not in {"entity_id", "seq", *SALON_POLICY.keep_first, *SALON_POLICY.last_non_null,
                      *SALON_POLICY.last_value}],
    )
    table = merge_entities(stored.unionByName(incoming, allowMissingColumns=True), policy)
    return table.withColumnRenamed("entity_id", "id").select(*current.columns), located


def duplicate_ids(salons: DataFrame) -> DataFrame:
    """(source, external_id) pairs that more than one record claims; must be empty."""
    claimed = salons.filter(F.trim("external_id") != "")
    return claimed.groupBy("external_source", "external_id").agg(F.count("*").alias("n")).filter("n > 1")
