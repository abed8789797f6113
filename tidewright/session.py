"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    STATE_STORE: ROCKSDB,
}


def build_session(app: str = "tidewright", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Partition counts, memory and the checkpoint folder belong to the cluster and
    are left to spark-submit; pass them in `extra` for local runs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def keep_states_apart(spark: SparkSession) -> None:
    """Makes streams started from here on keep their state in RocksDB where the session was
    built elsewhere and has Spark's default store, which cannot hold several states of one
    operator. A provider set by hand stays, and a checkpoint goes on with the store it began with."""
    if spark.conf.get(STATE_STORE).endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, ROCKSDB)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    Only a local master may fall back to a folder of its own; elsewhere the
    setting is required, since executors do not share a machine's /tmp.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root(spark.sparkContext.applicationId)
    return root.rstrip("/")


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix="tidewright-")


def scratch(spark: SparkSession, name: str) -> str:
    """A path not used before, below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Stores the rows as a table in the shared folder and goes on from there: it
    survives the loss of any executor, computes the rows once (a checkpoint of rows
    that are not cached computes them twice) and brings sizes for the planner."""
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Sends this package's code to the Python workers, which need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_tidewright_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidewright-code-"), "tidewright_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    context._tidewright_shipped = True


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark reads."""
    files, place = _file_system(spark, path)
    return files.exists(place)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is none."""
    files, place = _file_system(spark, path)
    return [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []


def make_folder(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder and all in it."""
    files, place = _file_system(spark, path)
    files.delete(place, True)
