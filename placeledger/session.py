"""Session settings the operators are written for."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A repeated key of a JSON object has its last value, as in most parsers.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Parsing is what costs: splits well under the default 128 MB spread it over the cores.
    "spark.sql.files.maxPartitionBytes": "32m",
}


def build_session(app: str = "placeledger", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings above; explicit `settings` win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by `spark.checkpoint.dir`.

    Only a local master, where driver and executors are one process, may do without
    the setting; it gets a temporary folder for the life of the session.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        if current.isEmpty():
            context.setCheckpointDir(named)
        return named
    if current.nonEmpty():
        return current.get()
    # Only here are driver and executors one process; local-cluster's are not.
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="placeledger-"))
    return context._jsc.sc().getCheckpointDir().get()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where nothing else does: it goes to them as a
    zip, once a session. Not needed where it is installed, on PYTHONPATH, or run in place."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if root in map(os.path.abspath, filter(None, paths)) or getattr(spark.sparkContext, "_placeledger_shipped", False):
        return
    name = os.path.join(tempfile.mkdtemp(prefix="placeledger-"), "placeledger")
    # The driver serves the file; no executor reads the driver's folder.
    spark.sparkContext.addPyFile(shutil.make_archive(name, "zip", root, "placeledger"))
    spark.sparkContext._placeledger_shipped = True


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder, for one run of a job."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read back, so a lost executor costs no
    recomputation of earlier steps. Unlike a plain checkpoint, the planner then knows
    the size of what it reads."""
    return write_step(df)[0]


def write_step(df: DataFrame) -> tuple[DataFrame, str]:
    """`cut_lineage`, with the folder, for whoever drops it later."""
    spark = df.sparkSession
    path = run_dir(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_step(spark: SparkSession, path: str) -> None:
    """Delete a step that nothing will read again, in whatever store the shared folder is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in whatever store it is; none where there is no such folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []
