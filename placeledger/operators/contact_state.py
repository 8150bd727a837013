"""Current contacts of entities from successive detail snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placeledger.operators.joins import lookup
from placeledger.operators.numbering import oldest_first, with_ids

KEY = ("salon_id", "contact_type", "normalized_value", "source")


def merge_contacts(current: DataFrame, checked: DataFrame, incoming: DataFrame, as_of: Column) -> DataFrame:
    """Contact table after a batch, with `change` per row: created, updated,
    deactivated, or unchanged.

    `checked` lists the (salon_id, source) pairs that were looked at, so that one whose
    contact list came back empty still loses its contacts. `incoming` has `pos`, its
    order; the last of equal contacts wins. Old and new rows meet in one aggregate on
    the contact key, which folds repeated rows before the shuffle; no outer join. New
    contacts get the next ids by salon and first arrival; that numbering runs when this
    is called.
    """
    carried = [
        c for c in ("display_value", "metadata", "first_seen_at", "last_seen_at", "is_active", "id") if c in current.columns
    ]
    old = current.select(*KEY, F.struct(*carried).alias("old"))
    payload = [c for c in ("display_value", "metadata") if c in incoming.columns and c in current.columns]
    new = incoming.select(
        *KEY, F.struct(*payload).alias("new"), F.col("pos").cast("bigint").alias("pos")
    )
    rows = old.unionByName(new, allowMissingColumns=True)
    paired = rows.groupBy(*KEY).agg(
        F.max("old.is_active").alias("was_active"),
        F.min_by("old", F.when(F.col("old").isNotNull(), oldest_first("old.", carried))).alias("old"),
        F.expr("max_by(new, pos) FILTER (WHERE new IS NOT NULL)").alias("new"),
        F.min("pos").alias("_arrival"),
    )
    looked_at = checked.select("salon_id", "source").distinct().withColumn("_checked", F.lit(True))
    joined = lookup(paired, looked_at, ["salon_id", "source"], "left")
    seen, known = F.col("new").isNotNull(), F.col("old").isNotNull()
    gone = ~seen & F.coalesce("_checked", F.lit(False)) & F.col("was_active")
    state = joined.withColumn(
        "change",
        F.when(seen & ~known, "created").when(seen, "updated").when(gone, "deactivated").otherwise("unchanged"),
    )
    touched = F.col("change") != "unchanged"
    out = {
        "is_active": F.when(seen, True).when(gone, False).otherwise(F.col("was_active")),
        "first_seen_at": F.coalesce(F.col("old.first_seen_at"), as_of),
        "last_seen_at": F.when(touched, as_of).otherwise(F.col("old.last_seen_at")),
    }
    for c in payload:
        out[c] = F.when(seen, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
    if "id" in current.columns:
        out["id"] = F.col("old.id")
    columns = [c for c in current.columns if c in out or c in KEY]
    table = state.select(*[out[c].alias(c) if c in out else F.col(c) for c in columns], "change", "_arrival")
    if "id" in columns:
        table = with_ids(table, current, "salon_id", "_arrival", "contact_type", "normalized_value", "source")
    return table.drop("_arrival")


def contact_change_counts(merged: DataFrame, *by: str) -> DataFrame:
    """How many contacts were created, updated and deactivated."""
    def of(change: str) -> Column:
        return F.count_if(F.col("change") == change).alias(change)

    return merged.groupBy(*by).agg(of("created"), of("updated"), of("deactivated"))
