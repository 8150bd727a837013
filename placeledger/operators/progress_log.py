"""Counters out of progress-log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from placeledger.fixed_values import LOG_HTTP_STATUS, LOG_PAYLOAD_CODE


def log_counts(lines: DataFrame, message: str = "message", by: tuple[str, ...] = ()) -> DataFrame:
    """How often each HTTP status and payload code was logged: kind, code, n."""
    def code(pattern: str):
        return F.regexp_extract(message, pattern, 1).try_cast("bigint")

    found = F.array(
        F.struct(F.lit("http_status").alias("kind"), code(LOG_HTTP_STATUS).alias("code")),
        F.struct(F.lit("payload_code").alias("kind"), code(LOG_PAYLOAD_CODE).alias("code")),
    )
    hits = lines.select(*by, F.inline(F.filter(found, lambda f: f["code"].isNotNull())))
    return hits.groupBy(*by, "kind", "code").agg(F.count("*").alias("n"))


def log_counters(lines: DataFrame, message: str = "message", by: tuple[str, ...] = ()) -> DataFrame:
    """The same counts as one map per kind, codes in order. Distinct codes are few, so
    the map stays small whatever the number of lines."""
    counts = log_counts(lines, message, by)
    entries = F.array_sort(F.collect_list(F.struct("code", "n")))
    return counts.groupBy(*by, "kind").agg(F.map_from_entries(entries).alias("counter"))
