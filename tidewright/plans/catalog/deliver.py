from pyspark.sql import functions as F

from ...operators.deliver import deliver, manifest, read_deliveries, record_delivery, undelivered
from ...schemas import EVENTS
from ...session import scratch
from ...sources.staged import deliver_staged, read_staged, stream_staged
from ...streaming.run import deliver_to, late_split, run_available
from .base import EVENT_SUM, event_stream, events, feed, plain_times, query
from .ingest import ALL_EVENTS


@query("deliver", "SELECT event_id, ts, user_id, event_type, value, props, event_type AS batch_id FROM events")
def twice(spark, sf):
    """A batch for each type, some of them delivered twice."""
    out, rows = scratch(spark, "out"), events(spark, sf)
    types = sorted(r[0] for r in rows.select("event_type").distinct().collect())
    for batch in [*types, *types[:2]]:
        deliver(rows.filter(F.col("event_type") == batch), out, batch)
    return read_deliveries(spark, out)


@query("manifest", "SELECT 'b1' AS batch_id, 'event_type=' || event_type AS part, count(*) AS n_rows FROM events GROUP BY 2")
def listed(spark, sf):
    return manifest(events(spark, sf), ["event_type"], "b1").select("batch_id", "part", "n_rows")


@query("manifest_checksum", f"""
    SELECT 'b1' AS batch_id, 'event_type=' || event_type AS part, count(*) AS n_rows, {EVENT_SUM} AS checksum FROM events GROUP BY 2""")
def summed(spark, sf):
    return manifest(events(spark, sf), ["event_type"], "b1").drop("created_ts")


@query("undelivered", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'error')")
def pending(spark, sf):
    """What remains after two batches are in the ledger, one of them entered twice."""
    ledger, rows = scratch(spark, "ledger"), events(spark, sf).select("event_id", "event_type")
    for batch in ("click", "error", "click"):
        record_delivery(rows.filter(F.col("event_type") == batch), ledger, "event_id", batch)
    return undelivered(rows, read_deliveries(spark, ledger), "event_id")


@query("run_available", ALL_EVENTS)
def restarted(spark, sf):
    """Run, stop, run again on the same checkpoint: nothing twice, nothing lost."""
    path, out, checkpoint = feed(spark, sf), scratch(spark, "out"), scratch(spark, "ck")
    for _ in range(2):
        run_available(event_stream(spark, path), deliver_to(out), checkpoint)
    return plain_times(read_deliveries(spark, out).drop("batch_id"))


@query("late_split", ALL_EVENTS)
def late(spark, sf):
    """Both sides together are the whole feed, whatever arrived late."""
    path = feed(spark, sf)
    on_time, missed, state = (scratch(spark, n) for n in ("on-time", "late", "state"))
    late_split(event_stream(spark, path), "ts", 3600, on_time, missed, state, scratch(spark, "ck"))
    both = read_deliveries(spark, on_time).unionByName(read_deliveries(spark, missed))
    return plain_times(both.drop("batch_id"))


@query("late_split_backwards", """
    WITH e AS (SELECT *, event_id % 4 AS file, epoch_us(ts) AS us FROM events),
    newest AS (SELECT f.file, max(e.us) AS before FROM (VALUES (1), (2), (3)) f(file) JOIN e ON e.file < f.file GROUP BY 1)
    SELECT event_id, coalesce(us < before - 3600000000, false) AS is_late FROM e LEFT JOIN newest USING (file)""")
def late_backwards(spark, sf):
    """Four files that each go over all the time: what the ones before have passed by more
    than an hour is late, and is kept."""
    path, rows = scratch(spark, "feed"), events(spark, sf)
    for file in range(4):
        rows.filter(F.col("event_id") % 4 == file).coalesce(1).write.mode("append").parquet(path)
    on_time, missed, state = (scratch(spark, n) for n in ("on-time", "late", "state"))
    late_split(event_stream(spark, path), "ts", 3600, on_time, missed, state, scratch(spark, "ck"))
    return (read_deliveries(spark, on_time).select("event_id", F.lit(False).alias("is_late"))
            .unionByName(read_deliveries(spark, missed).select("event_id", F.lit(True).alias("is_late"))))


@query("deliver_datasource", "SELECT event_id, ts, user_id, event_type, value, props, event_type AS batch_id FROM events")
def staged(spark, sf):
    """A batch for each type, all of them sent twice, the second time with other rows."""
    out, rows = scratch(spark, "staged"), events(spark, sf)
    for value in (F.col("value"), F.col("value") + 1):
        for batch in ("click", "error", "purchase", "signup", "view"):
            deliver_staged(rows.filter(F.col("event_type") == batch).withColumn("value", value), out, batch)
    return read_staged(spark, out, EVENTS)


@query("deliver_datasource_stream", ALL_EVENTS)
def staged_stream(spark, sf):
    """The events as a stream, published micro-batch by micro-batch over two runs."""
    path, out, checkpoint = feed(spark, sf), scratch(spark, "staged"), scratch(spark, "ck")
    for _ in range(2):
        stream_staged(event_stream(spark, path, 2).withColumn("ts", F.col("ts").cast("timestamp_ntz")), out, checkpoint)
    return read_staged(spark, out, EVENTS).drop("batch_id")
