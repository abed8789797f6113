"""Running streams so that stopping, crashing and starting again change nothing."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.timecols import micros
from ..session import names_in
from ..sources.sinks import deliver


PARTITIONS = "spark.sql.shuffle.partitions"


def python_tasks(spark: SparkSession) -> int:
    """Tasks that keep all cores busy with workers in Python: two for each."""
    return 2 * spark.sparkContext.defaultParallelism


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None] | str, checkpoint: str,
                  mode: str = "append", fmt: str = "parquet", timeout: float | None = None, state_tasks: int | None = None):
    """Processes what is there and stops. A path makes an append-only file sink; a
    function gets (micro-batch, batch id) and must be repeatable per batch id.
    Running again with the same checkpoint handles only what is new.

    `state_tasks` bounds the tasks among which a new checkpoint deals out its state (else all
    of spark.sql.shuffle.partitions): each starts a Python worker in every micro-batch where
    the state is kept by a processor in Python."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    conf = stream.sparkSession.conf
    given = conf.get(PARTITIONS)
    if state_tasks is not None:  # a query takes its settings along when it starts
        conf.set(PARTITIONS, str(min(int(given), state_tasks)))
    try:
        query = (writer.foreachBatch(sink).start() if callable(sink)
                 else writer.format(fmt).option("path", sink).start())
    finally:
        if state_tasks is not None:
            conf.set(PARTITIONS, given)
    query.awaitTermination(timeout) if timeout else query.awaitTermination()
    return query


def deliver_to(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A sink that writes each micro-batch to the folder of its batch id."""
    return lambda batch, batch_id: deliver(batch, path, batch_id, fmt)


def dropped_rows(query) -> int:
    """Rows the watermark has discarded over a query's micro-batches."""
    return sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)


STATE = T.StructType([T.StructField("max_us", T.LongType())])


def late_split(stream: DataFrame, ts: str, delay_seconds: float, on_time: str, late: str, state: str,
               checkpoint: str):
    """Writes rows later than the delay allows to `late`, all others to `on_time`.

    A row is late when it lies more than the delay before the newest event time of
    the earlier micro-batches. Spark's own watermark takes effect a batch later, so
    everything it would drop without a word is among the late rows. The newest time
    is one number per batch in `state`; every write is keyed by batch id, so a
    repeated batch gives the same split.
    """
    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = None
        if batch_id > 0:
            before = spark.read.schema(STATE).parquet(f"{state}/batch_id={batch_id - 1}").first()["max_us"]
        limit = None if before is None else before - round(delay_seconds * 1e6)
        rows = batch.withColumn("is_late", F.lit(False) if limit is None
                                else F.coalesce(micros(ts) < F.lit(limit), F.lit(False)))
        rows = rows.persist()
        try:
            deliver(rows.filter(~F.col("is_late")).drop("is_late"), on_time, batch_id)
            deliver(rows.filter("is_late").drop("is_late"), late, batch_id)
            newest = rows.agg(F.greatest(F.max(micros(ts)), F.lit(before).cast("bigint")).alias("max_us"))
            deliver(newest.coalesce(1), state, batch_id)
        finally:
            rows.unpersist()

    return run_available(stream, split, checkpoint)


def latest_table(stream: DataFrame, key: str, ts: str, tie: list[str], path: str, checkpoint: str):
    """Keeps the newest row per entity: the streaming aggregate sends the entities
    that changed, each micro-batch is stored under its id, and `read_latest` takes
    the newest of them."""
    from ..operators.fuse import latest_state
    return run_available(latest_state(stream, key, ts, tie), deliver_to(path), checkpoint, mode="update")


def read_latest(spark: SparkSession, path: str, key: str, ts: str, tie: list[str]) -> DataFrame:
    from ..operators.fuse import latest_state
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch_id=*").drop("batch_id")
    return latest_state(rows, key, ts, tie)


SEEN = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("n_rows", T.LongType()),
])


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(stage, batch_id, n_rows) of all runs so far."""
    if not names_in(spark, path):
        return spark.createDataFrame([], SEEN)
    return spark.read.option("basePath", path).schema(SEEN).parquet(f"{path}/stage=*/batch_id=*").select(SEEN.names)


def counted(stream: DataFrame, stage: str) -> DataFrame:
    """The rows as they are, counted on their way through each micro-batch under a stage's
    name. Rows are counted where they pass: leave no shuffle between here and a sink that
    writes once per micro-batch, or tasks that run again are counted again."""
    return stream.observe(stage, F.count(F.lit(1)).alias("n_rows"))


class BatchCounts(StreamingQueryListener):
    """Gathers what `counted` saw into a table below `path`, a folder per stage and
    micro-batch, so that a micro-batch that is repeated after a crash replaces its count.
    Use it as a context around the runs: leaving waits for the counts of all that ended."""

    def __init__(self, spark: SparkSession, path: str, patience: float = 60):
        self.spark, self.path, self.patience = spark, path, patience
        self._open, self._change = {}, threading.Condition()

    def __enter__(self) -> BatchCounts:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        with self._change:
            quiet = self._change.wait_for(lambda: all(self._open.values()), self.patience)
        self.spark.streams.removeListener(self)
        if not quiet and error[0] is None:
            raise TimeoutError("a query that ended has not told its last counts")

    def onQueryStarted(self, event) -> None:
        self._told(event.runId, False)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for stage, seen in progress.observedMetrics.items():
            if seen["n_rows"] is not None:
                row = self.spark.createDataFrame([(stage, progress.batchId, seen["n_rows"])], SEEN)
                deliver(row.select("n_rows").coalesce(1), f"{self.path}/stage={stage}", progress.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._told(event.runId, True)

    def _told(self, run, ended: bool) -> None:
        with self._change:
            self._open[str(run)] = ended
            self._change.notify_all()
