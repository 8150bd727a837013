"""Incremental forms: landing to history, history to current state, and two filters.

Every sink writes below a folder named by its batch id, so a replayed batch replaces
its own output instead of adding to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from placeledger.operators.classify import classify_entities
from placeledger.operators.merge import merge_sightings
from placeledger.operators.parse_search import parse_search
from placeledger.sources import buckets
from placeledger.sources.sinks import read_snapshot, versions, write_snapshot


def decided_sightings(responses: DataFrame, words: dict | None = None, page_size: int = 10) -> DataFrame:
    """Search responses (stream or batch) parsed and classified, row by row."""
    sightings, _ = parse_search(responses, page_size)
    return classify_entities(sightings, **({"words": words} if words else {}))


def append_available(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append everything that has landed so far, exactly once, and stop."""
    return (
        stream.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def merge_available(stream: DataFrame, root: str, checkpoint: str, as_of: Column,
                    words: dict | None = None, history: str | None = None) -> StreamingQuery:
    """Merge each micro-batch of sightings into the snapshot table under `root`.

    A version is named by the stream (the id in its checkpoint) and the batch, and a batch
    whose version was ever current is skipped: a restart cannot merge it twice, and another
    stream, whose batches are numbered from 0 too, is not mistaken for it. With `history`,
    the batch's decided sightings are kept there, each batch in a folder of its own that a
    replay replaces; discoveries are never changed later.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{stream_id(spark, checkpoint)}-{batch_id}"
        if versions(spark, root).filter(F.col("version") == name).limit(1).count():
            return
        table, located = merge_sightings(read_snapshot(spark, root), batch, as_of, words)
        if history:
            located.write.mode("overwrite").parquet(f"{history}/batch={name}")
        write_snapshot(table, root, name)

    return (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def merge_touched(stream: DataFrame, root: str, checkpoint: str,
                  merge: Callable[[DataFrame, DataFrame], DataFrame], keep: int = 2) -> StreamingQuery:
    """Merge each micro-batch into a bucketed table: only the buckets of the batch's keys are read
    and written again, and versions older than the last `keep` go. A replayed batch is known
    by its name, which the version it made still has."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        buckets.merge_batch(batch, root, merge, f"{stream_id(spark, checkpoint)}-{batch_id}")
        buckets.expire_versions(spark, root, keep)

    return (
        stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a stream keeps in its checkpoint across restarts."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def drop_repeats(stream: DataFrame, keys: list[str], event_time: str, within: str = "1 day") -> DataFrame:
    """First of equal observations seen within the watermark. State is dropped as the
    watermark passes, so it stays bounded."""
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, within).dropDuplicatesWithinWatermark(keys)


def stale_runs(runs: DataFrame, as_of: Column, minutes: int) -> DataFrame:
    """Runs with the ones still `running` after `minutes` marked as interrupted."""
    stale = (F.col("status") == "running") & (
        F.col("started_at") + F.expr(f"INTERVAL {int(minutes)} MINUTES") < as_of
    )
    return runs.withColumns(
        {
            "status": F.when(stale, "interrupted").otherwise(F.col("status")),
            "finished_at": F.when(stale, as_of).otherwise(F.col("finished_at")),
            "error_message": F.when(
                stale, F.coalesce("error_message", F.lit("stale run recovered"))
            ).otherwise(F.col("error_message")),
        }
    )


def heartbeat_sessions(heartbeats: DataFrame, minutes: int, run: str = "run_id", at: str = "ts",
                       watermark: str | None = None) -> DataFrame:
    """Alive spans of runs: beats closer than the gap belong together. In a stream, a
    span comes out once the watermark says that no further beat can extend it.

    In a batch, beats are first folded where they lie: those of one half gap's length are
    closer than the gap, so a busy run sends a row for each such stretch, not for each beat.
    """
    beats = heartbeats.withColumn(at, F.col(at).cast("timestamp"))
    if heartbeats.isStreaming:
        beats = beats.withWatermark(at, watermark) if watermark else beats
        return beats.groupBy(run, F.session_window(at, f"{int(minutes)} minutes").alias("span")).agg(
            F.count("*").alias("beats"), F.min(at).alias("first_beat"), F.max(at).alias("last_beat")
        ).drop("span")
    stretch = F.floor(F.unix_micros(at) / (int(minutes) * 30_000_000))
    folded = beats.filter(F.col(at).isNotNull()).groupBy(run, stretch.alias("_stretch")).agg(
        F.count("*").alias("_beats"), F.min(at).alias("_first"), F.max(at).alias("_last"))
    # A stretch lasts from its first beat to a gap after its last.
    lasts = (F.unix_micros("_last") - F.unix_micros("_first")) / 1_000_000 + int(minutes) * 60
    return folded.groupBy(run, F.session_window("_first", F.make_interval(secs=lasts)).alias("span")).agg(
        F.sum("_beats").alias("beats"), F.min("_first").alias("first_beat"), F.max("_last").alias("last_beat")
    ).drop("span")
