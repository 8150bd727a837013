"""Paired comparison of two query profiles per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def profile_ids(sightings: DataFrame, full: str, reduced: str) -> DataFrame:
    """One row per cell and entity id with the decision each profile last saw (`full`,
    `reduced`; NULL = not seen). A cell seen without any id keeps one row with a NULL id.

    `sightings` has cell_id, profile, external_id, accepted, seq.
    """
    both = sightings.filter(F.col("profile").isin(full, reduced))

    def last(profile: str, name: str) -> Column:
        mine = F.col("profile") == profile
        return F.max_by(F.when(mine, F.col("accepted")), F.when(mine, F.col("seq"))).alias(name)

    ids = both.withColumn("external_id", F.nullif("external_id", F.lit("")))
    return ids.groupBy("cell_id", "external_id").agg(last(full, "full"), last(reduced, "reduced"))


def profile_differences(ids: DataFrame) -> DataFrame:
    """Rows of `profile_ids` only one profile has: cell_id, external_id, side
    (missing_from_reduced or extra_in_reduced) and accepted."""
    only_full = F.col("full").isNotNull() & F.col("reduced").isNull()
    only_reduced = F.col("full").isNull() & F.col("reduced").isNotNull()
    return ids.filter("external_id IS NOT NULL").filter(only_full | only_reduced).select(
        "cell_id", "external_id",
        F.when(only_full, "missing_from_reduced").otherwise("extra_in_reduced").alias("side"),
        F.coalesce("full", "reduced").alias("accepted"),
    )


def compare_profiles(ids: DataFrame) -> DataFrame:
    """Counts per cell over `profile_ids`, and the Jaccard similarity of the two id
    sets (1.0 when both are empty). The ids themselves are in `profile_differences`."""
    known = F.col("external_id").isNotNull()
    in_full, in_reduced = known & F.col("full").isNotNull(), known & F.col("reduced").isNotNull()
    missing = in_full & ~in_reduced
    counts = ids.groupBy("cell_id").agg(
        F.count_if(in_full).alias("full_ids"),
        F.count_if(in_reduced).alias("reduced_ids"),
        F.count_if(in_full & in_reduced).alias("common"),
        F.count_if(missing).alias("missing_from_reduced"),
        F.count_if(in_reduced & ~in_full).alias("extra_in_reduced"),
        F.count_if(missing & F.col("full")).alias("accepted_missing"),
        F.count_if(missing & ~F.col("full")).alias("rejected_missing"),
        F.count_if(known).alias("_union"),
    )
    jaccard = F.when(F.col("_union") == 0, F.lit(1.0)).otherwise(F.col("common") / F.col("_union"))
    return counts.withColumn("jaccard", jaccard).drop("_union")
