"""A sink that publishes a delivery in one step, whatever happens to its tasks.

Tasks write files nobody reads yet; the commit on the driver names those of the tasks that
succeeded in one small list per batch id, and readers go by the lists. So a killed task, a
task run twice or a driver that dies before the commit leave nothing to be read, and a
batch id is published once: a second call with it drops what it wrote.

Files and lists go through `pyarrow.fs` (local, HDFS, S3, GCS). The list is written beside
its place and moved there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from ..session import ship_package

FORMAT = "staged_delivery"


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass
class Staged(WriterCommitMessage):
    """What a task has written: a file (run/name) below `data`, if it had any rows."""

    name: str | None
    rows: int


class Store:
    """The folder of a sink: `data/<run>/` with files, `published/<batch>.json` with lists."""

    def __init__(self, path: str, run: str):
        self.path, self.run = path, run

    def stage(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        """Writes a task's rows to a file of its own; what fails on the way is removed."""
        files, base = open_path(self.path)
        folder, name, rows, writer = f"{base}/data/{self.run}", f"{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if writer is None:
                    files.create_dir(folder)
                    writer = pq.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=files)
                writer.write_batch(batch)
                rows += batch.num_rows
            if writer is not None:
                writer.close()
        except BaseException:
            if writer is not None:
                writer.close()
                files.delete_file(f"{folder}/{name}")
            raise
        return Staged(f"{self.run}/{name}" if writer is not None else None, rows)

    def publish(self, batch: str, staged: list[Staged | None]) -> None:
        """Names the files of a batch, unless the batch has been published before."""
        files, base = open_path(self.path)
        done = [s for s in staged if s is not None and s.name]
        place = f"{base}/published/{quote(batch, safe='')}.json"
        if files.get_file_info(place).type != pafs.FileType.NotFound:
            self.drop(done)
            return
        files.create_dir(f"{base}/published")
        beside = f"{base}/published/.{self.run}.{uuid.uuid4().hex}"
        told = {"batch_id": batch, "rows": sum(s.rows for s in done), "files": [s.name for s in done]}
        with files.open_output_stream(beside) as out:
            out.write(json.dumps(told).encode())
        files.move(beside, place)

    def drop(self, staged: list[Staged | None]) -> None:
        files, base = open_path(self.path)
        for s in staged:
            if s is not None and s.name:
                files.delete_file(f"{base}/data/{s.name}")

    def drop_run(self) -> None:
        """Removes all that the tasks of this run have written, told or not."""
        files, base = open_path(self.path)
        files.delete_dir_contents(f"{base}/data/{self.run}", missing_dir_ok=True)


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, store: Store, batch: str):
        self.store, self.batch = store, batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.store.stage(iterator)

    def commit(self, messages: list[Staged | None]) -> None:
        self.store.publish(self.batch, messages)

    def abort(self, messages: list[Staged | None]) -> None:
        self.store.drop_run()


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, store: Store, prefix: str):
        self.store, self.prefix = store, prefix

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.store.stage(iterator)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        self.store.publish(f"{self.prefix}{batchId}", messages)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self.store.drop(messages)


class StagedDelivery(DataSource):
    """Options: path; batch_id of a batch write, or prefix for the ids of micro-batches."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _store(self) -> Store:
        return Store(self.options["path"].rstrip("/"), uuid.uuid4().hex)

    def writer(self, schema: T.StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(self._store(), self.options["batch_id"])

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self._store(), self.options.get("prefix", ""))


def register_staged(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(StagedDelivery)


def deliver_staged(df: DataFrame, path: str, batch_id: str | int) -> None:
    """Publishes one delivery; a batch id that has been published already stays as it is."""
    register_staged(df.sparkSession)
    df.write.format(FORMAT).mode("append").option("batch_id", str(batch_id)).save(path)


def stream_staged(stream: DataFrame, path: str, checkpoint: str, prefix: str = ""):
    """Publishes each micro-batch of what is there, and stops. A micro-batch that Spark
    repeats after a crash is not published again."""
    register_staged(stream.sparkSession)
    query = (stream.writeStream.format(FORMAT).options(prefix=prefix, checkpointLocation=checkpoint)
             .trigger(availableNow=True).start(path))
    query.awaitTermination()
    return query


def published(path: str) -> list[dict]:
    """The lists of all batches: batch_id, rows, files."""
    files, base = open_path(path.rstrip("/"))
    found = files.get_file_info(pafs.FileSelector(f"{base}/published", allow_not_found=True))
    lists = []
    for info in sorted((f for f in found if f.base_name.endswith(".json")), key=lambda f: f.base_name):
        with files.open_input_stream(info.path) as text:
            lists.append(json.loads(text.read()))
    return lists


def read_staged(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows of all published deliveries, with their batch ids."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    root = path.rstrip("/")
    batches = {f: told["batch_id"] for told in published(root) for f in told["files"]}
    if not batches:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())]))
    rows = spark.read.schema(schema).parquet(*[f"{root}/data/{f}" for f in batches])
    names = spark.createDataFrame([(f, b) for f, b in batches.items()], "__file string, batch_id string")
    rows = rows.withColumn("__file", F.regexp_extract(F.col("_metadata.file_path"), "([^/]+/[^/]+)$", 1))
    return rows.join(F.broadcast(names), "__file").select(*schema.names, "batch_id")


def sweep(path: str) -> int:
    """Removes files that no list names: the leavings of killed tasks and drivers. To be run
    while nothing writes there. Returns how many there were."""
    files, base = open_path(path.rstrip("/"))
    named = {f for told in published(path) for f in told["files"]}
    left = [info.path for info in files.get_file_info(pafs.FileSelector(f"{base}/data", recursive=True, allow_not_found=True))
            if info.is_file and "/".join(unquote(info.path).split("/")[-2:]) not in named]
    for name in left:
        files.delete_file(name)
    return len(left)
