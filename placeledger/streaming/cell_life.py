"""Life of grid cells as a stream: attempts, outcomes and time-outs in keyed state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

_STATE = "cells binary"
_NEWS = "cell_id bigint, change bigint, status string, attempts bigint, interrupted boolean, micros bigint"
# A cell in the state of its bucket; `status` is a place in _STATUSES.
_CELL = [("cell_id", "<i8"), ("attempt", "<i8"), ("rank", "<i8"), ("micros", "<i8"), ("status", "<i1"), ("interrupted", "<i1"), ("change", "<i8")]
_STATUSES = ("in_progress", "pending", "failed", "completed")
# What outranks what among the events of one attempt.
EVENT_RANKS = {"running": 0, "failed": 1, "complete": 2}


def cell_changes(events: DataFrame, retry_limit: int, stale_minutes: int, late: str = "1 day", buckets: int = 1024) -> DataFrame:
    """Changes of cells from the events of their attempts (cell_id, attempt, event, at).

    Attempts of a cell are numbered from 1; the furthest event of the last one decides, so
    repeated events and events that arrive out of order within `late` change nothing. complete
    ends a cell; failed opens it again while attempts are left; an attempt that runs for
    `stale_minutes` of event time without an end is interrupted, which opens the cell again
    or, without attempts left, leaves it in progress. An end that still comes counts. Events
    later than `late` are dropped, and so are those without a cell, attempt, time or known event.

    One row a change, numbered by cell. Cells are dealt to `buckets` by a hash; a bucket's
    cells are one row of state, 42 bytes each, and are settled together as arrays, with one
    timer for the earliest of them. Events come in chunks of bounded size. The number of
    buckets must stay the same as long as a checkpoint is used.
    """
    def furthest(rows):
        return rows.sort_values(["cell_id", "attempt", "rank", "micros"]).drop_duplicates("cell_id", keep="last")

    def life(key: tuple, chunks: Iterator, state) -> Iterator:
        import numpy as np
        import pandas as pd

        cells = pd.DataFrame(np.frombuffer(bytes(state.get[0]) if state.exists else b"", dtype=_CELL)).set_index("cell_id")
        order = ["cell_id", "attempt", "rank", "micros"]
        reached = cells.reset_index()[order]
        for chunk in [] if state.hasTimedOut else chunks:
            reached = furthest(pd.concat([reached, furthest(chunk[order])]))
        reached = reached.set_index("cell_id").sort_index()
        before = cells.reindex(reached.index, fill_value=0)
        attempt, rank = reached["attempt"].to_numpy(), reached["rank"].to_numpy()
        due = (reached["micros"].to_numpy() + stale_minutes * 60_000_000) // 1000
        now = state.getCurrentWatermarkMs()
        over = (rank == 0) & (due < now)
        open_again = np.where(attempt < retry_limit, 1, 2)
        status = np.select([rank == 2, rank == 1, over & (attempt < retry_limit)], [3, open_again, 1], 0)
        # Attempts count as a change too: a cell may fail twice in one batch.
        changed = (before["change"].to_numpy() == 0) | (status != before["status"].to_numpy()) | (
            over != before["interrupted"].to_numpy()) | (attempt != before["attempt"].to_numpy())
        after = np.zeros(len(reached), dtype=_CELL)
        for name, values in (("cell_id", reached.index), ("attempt", attempt), ("rank", rank), ("micros", reached["micros"]),
                             ("status", status), ("interrupted", over), ("change", before["change"] + changed)):
            after[name] = values
        state.update((after.tobytes(),))
        waiting = due[(rank == 0) & ~over]
        if len(waiting):
            state.setTimeoutTimestamp(int(max(waiting.min(), now + 1)))
        news = after[changed]
        if len(news):
            yield pd.DataFrame({
                "cell_id": news["cell_id"], "change": news["change"], "status": np.array(_STATUSES, dtype=object)[news["status"]],
                "attempts": news["attempt"], "interrupted": news["interrupted"].astype(bool), "micros": news["micros"]})

    rank = F.lit(None).cast("bigint")
    for name, number in EVENT_RANKS.items():
        rank = F.when(F.col("event") == name, number).otherwise(rank)
    known = events.select(
        F.col("cell_id").cast("bigint").alias("cell_id"), F.col("attempt").cast("bigint").alias("attempt"),
        rank.cast("bigint").alias("rank"), F.col("at").cast("timestamp").alias("at"),
    ).filter("cell_id IS NOT NULL AND attempt IS NOT NULL AND rank IS NOT NULL AND at IS NOT NULL")
    dealt = known.withWatermark("at", late).withColumns(
        {"micros": F.unix_micros("at"), "bucket": F.pmod(F.hash("cell_id"), F.lit(buckets))})
    news = dealt.groupBy("bucket").applyInPandasWithState(life, _NEWS, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return news.withColumn("at", F.timestamp_micros("micros")).drop("micros")


def current_cells(changes: DataFrame) -> DataFrame:
    """Every cell after its last change."""
    last = F.max_by(F.struct("status", "attempts", "interrupted", "at"), "change").alias("last")
    return changes.groupBy("cell_id").agg(last).select("cell_id", "last.*")


def numbered_attempts(attempts: DataFrame) -> DataFrame:
    """Stored attempts (id, cell_id) with `attempt`, their number within the cell."""
    return attempts.withColumn("attempt", F.row_number().over(W.partitionBy("cell_id").orderBy("id")).cast("bigint"))
