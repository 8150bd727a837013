"""Current state in buckets of its key, so that a batch rewrites only the buckets it touches.

    root/data/<folder>/bucket=<b>     rows of a bucket as one version wrote them
    root/manifests/version=<n>        a row a bucket: the folder that holds it now and its rows;
                                      and one row (bucket -1) with the table's own settings

Versions are numbered. The one with the greatest number whose manifest is complete is current,
whatever the writers' clocks say, and a writer that finds its number taken fails instead of
hiding the other's rows. Old versions keep their files until they are expired.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from placeledger.session import drop_step, list_names

SETTINGS = -1
MANIFEST = "bucket int, folder string, rows bigint, name string, settings string"


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def stored_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    found = [n for n in list_names(spark, f"{root}/manifests") if n.startswith("version=")]
    whole = [n for n in found if "_SUCCESS" in list_names(spark, f"{root}/manifests/{n}")]
    return sorted(int(n.removeprefix("version=")) for n in whole)


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(bucket, folder, rows, name, settings) of a version, by default the current one."""
    known = stored_versions(spark, root)
    if not known:
        raise ValueError(f"no table under {root}")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifests/version={known[-1] if version is None else version:08d}")


def _commit(spark: SparkSession, root: str, version: int, entries: list[tuple], name: str | None, settings: dict) -> None:
    rows = [(b, folder, n, None, None) for b, folder, n in entries]
    rows.append((SETTINGS, None, 0, name, json.dumps(settings)))
    # Fails where the number is taken.
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{root}/manifests/version={version:08d}")


def _write(rows: DataFrame, root: str, key: list[str], buckets: int) -> list[tuple[int, str, int]]:
    """Write rows by bucket into a folder of their own: (bucket, folder, rows) of each."""
    spark, folder = rows.sparkSession, uuid.uuid4().hex
    # One or more files a bucket; adaptive execution splits one that is too large.
    dealt = rows.withColumn("bucket", bucket_of(key, buckets)).hint("rebalance", "bucket")
    dealt.write.partitionBy("bucket").parquet(f"{root}/data/{folder}")
    if not any(n.startswith("bucket=") for n in list_names(spark, f"{root}/data/{folder}")):
        return []
    counts = spark.read.parquet(f"{root}/data/{folder}").groupBy("bucket").count().collect()
    return [(r["bucket"], folder, r["count"]) for r in counts]


def create_table(rows: DataFrame, root: str, key: list[str], buckets: int = 64, name: str | None = None) -> None:
    """Version 0 of a table with one row a key. `buckets` stays for the table's life: it bounds
    the manifest, and with the table's size gives the size of what a batch rewrites."""
    settings = {"key": key, "buckets": buckets, "schema": json.loads(rows.schema.json())}
    _commit(rows.sparkSession, root, 0, _write(rows, root, key, buckets), name, settings)


def _settings(rows: list) -> dict:
    return json.loads(next(r["settings"] for r in rows if r["bucket"] == SETTINGS))


def _read(spark: SparkSession, root: str, rows: list, only: set[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(_settings(rows)["schema"])
    paths = [f"{root}/data/{r['folder']}/bucket={r['bucket']}" for r in rows
             if r["bucket"] != SETTINGS and (only is None or r["bucket"] in only)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """All rows of a version, by default the current one."""
    return _read(spark, root, manifest(spark, root, version).collect())


def touched_buckets(batch: DataFrame, key: list[str], buckets: int) -> set[int]:
    return {r[0] for r in batch.select(bucket_of(key, buckets)).distinct().collect()}


def rows_like(spark: SparkSession, root: str, batch: DataFrame) -> DataFrame:
    """The current rows of the batch's keys; only the buckets they fall into are read."""
    rows = manifest(spark, root).collect()
    own = _settings(rows)
    wanted = batch.select(*own["key"]).distinct()
    return _read(spark, root, rows, touched_buckets(wanted, own["key"], own["buckets"])).join(
        wanted.hint("merge"), own["key"], "left_semi")


def merge_batch(
    batch: DataFrame, root: str, merge: Callable[[DataFrame, DataFrame], DataFrame], name: str | None = None,
) -> int:
    """Merge a batch into the table and return the version's number.

    `merge` gets the current rows of the touched buckets and the batch (which has the key's
    columns), and returns what those buckets hold from now on; it must keep the rows that the
    batch says nothing about. Buckets without a key of the batch keep their files. A batch whose
    `name` a stored version has already is skipped, so a replay changes nothing; a batch with
    null keys has them in a bucket like any other.
    """
    spark = batch.sparkSession
    known = stored_versions(spark, root)
    if name is not None:
        names = {v: manifest(spark, root, v).filter(F.col("name") == name).limit(1).count() for v in reversed(known)}
        if any(names.values()):
            return next(v for v, n in names.items() if n)
    rows = manifest(spark, root, known[-1]).collect()
    own = _settings(rows)
    touched = touched_buckets(batch, own["key"], own["buckets"])
    before = _read(spark, root, rows, touched)
    after = merge(before, batch).select(*before.columns)
    fresh = _write(after, root, own["key"], own["buckets"])
    strays = {b for b, _, _ in fresh} - touched
    if strays:
        raise ValueError(f"merge made rows for buckets that the batch does not touch: {sorted(strays)[:5]}")
    kept = [(r["bucket"], r["folder"], r["rows"]) for r in rows if r["bucket"] not in touched | {SETTINGS}]
    _commit(spark, root, known[-1] + 1, kept + fresh, name, own)
    return known[-1] + 1


def expire_versions(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Forget all but the last `keep` versions and delete the files that only they hold. Readers
    of an expired version fail from then on. Returns the number of bucket folders deleted."""
    known = stored_versions(spark, root)
    old, new = known[:-keep], known[-keep:]

    def held(versions: list[int]) -> set[tuple[str, int]]:
        return {(r["folder"], r["bucket"]) for v in versions for r in manifest(spark, root, v).collect() if r["bucket"] != SETTINGS}

    gone = held(old) - held(new)
    for folder, bucket in gone:
        drop_step(spark, f"{root}/data/{folder}/bucket={bucket}")
    for v in old:
        drop_step(spark, f"{root}/manifests/version={v:08d}")
    return len(gone)
