"""Stop, crash, repeat, late data: the stored result must not care."""

import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewright.operators.correlate import interval_correlate, session_spans
from tidewright.operators.deliver import manifest, read_deliveries
from tidewright.operators.final import merge_into, period_summary
from tidewright.operators.ingest import dedup
from tidewright.plans.catalog.base import as_obs, event_stream, events
from tidewright.schemas import EVENTS
from tidewright.sources.readers import stream_source
from tidewright.sources.sinks import XML_TIMES, deliver, write_final, write_split, write_xml
from tidewright.operators.validate import reconcile_stream
from tidewright.streaming.run import BatchCounts, counted, deliver_to, dropped_rows, late_split, read_counts, run_available

SF = "/root/testdata/sf0.001"


def write_feed(spark, path, order):
    """The events in four time ranges, file times set by hand to the given order."""
    rows_ = events(spark, SF)
    ends = rows_.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    step = (ends["b"] - ends["a"]) / 4
    for i in range(4):
        lo, hi = ends["a"] + step * i, ends["a"] + step * (i + 1) + timedelta(seconds=i == 3)
        part = rows_.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(f"{path}/t{i}")
        for name in os.listdir(f"{path}/t{i}"):
            if name.startswith("part-"):
                at = 1_700_000_000 + 60 * order.index(i)
                os.utime(f"{path}/t{i}/{name}", (at, at))
    return f"{path}/t*"


@pytest.fixture()
def ordered(spark, tmp_path):
    return write_feed(spark, str(tmp_path / "feed"), [0, 1, 2, 3])


@pytest.fixture()
def backwards(spark, tmp_path):
    return write_feed(spark, str(tmp_path / "feed"), [3, 2, 1, 0])


def test_running_again_adds_nothing(spark, ordered, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for _ in range(3):
        run_available(event_stream(spark, ordered), out, ck)
    got = spark.read.parquet(out)
    assert got.count() == 1000 and got.select("event_id").distinct().count() == 1000


def test_xml_files_as_a_stream(spark, tmp_path):
    path, out = str(tmp_path / "xml"), str(tmp_path / "out")
    write_xml(events(spark, SF), path, "events", "event")
    stream = stream_source(spark, path, "xml", EVENTS, 1, rowTag="event", **XML_TIMES)
    run_available(stream, out, str(tmp_path / "ck"))
    assert rows(spark.read.parquet(out)) == rows(events(spark, SF))


def test_crash_between_write_and_commit(spark, ordered, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    write = deliver_to(out)

    def crash(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 2:
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        run_available(event_stream(spark, ordered), crash, ck)
    assert 0 < read_deliveries(spark, out).count() < 1000
    run_available(event_stream(spark, ordered), write, ck)
    got = read_deliveries(spark, out)
    assert got.count() == 1000 and got.select("event_id").distinct().count() == 1000


def test_stop_between_batches(spark, ordered, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    query = (event_stream(spark, ordered).writeStream.option("checkpointLocation", ck)
             .foreachBatch(deliver_to(out)).trigger(processingTime="0 seconds").start())
    end = time.time() + 60
    while not query.recentProgress and time.time() < end:
        time.sleep(0.1)
    query.stop()
    run_available(event_stream(spark, ordered), deliver_to(out), ck)
    assert read_deliveries(spark, out).count() == 1000


def test_late_rows_are_kept_aside_not_lost(spark, backwards, tmp_path):
    on_time, late, state = (str(tmp_path / n) for n in ("on", "late", "state"))
    late_split(event_stream(spark, backwards), "ts", 3600, on_time, late, state, str(tmp_path / "ck"))
    a, b = read_deliveries(spark, on_time), read_deliveries(spark, late)
    assert a.count() + b.count() == 1000 and b.count() > 500
    assert a.unionByName(b).select("event_id").distinct().count() == 1000


def test_late_split_keeps_all_that_the_watermark_drops(spark, backwards, tmp_path):
    q = run_available(dedup(event_stream(spark, backwards), ["event_id"], ts="ts", delay="1 hour"),
                      str(tmp_path / "out"), str(tmp_path / "ck"))
    late_split(event_stream(spark, backwards), "ts", 3600, *[str(tmp_path / n) for n in ("on", "late", "state", "ck2")])
    late = read_deliveries(spark, str(tmp_path / "late")).select("event_id")
    kept = spark.read.parquet(str(tmp_path / "out")).select("event_id")
    gone = events(spark, SF).select("event_id").join(kept, "event_id", "left_anti")
    assert gone.count() == dropped_rows(q) > 0 and gone.join(late, "event_id", "left_anti").count() == 0


def test_nothing_is_late_in_order(spark, ordered, tmp_path):
    on_time, late, state = (str(tmp_path / n) for n in ("on", "late", "state"))
    late_split(event_stream(spark, ordered), "ts", 3600, on_time, late, state, str(tmp_path / "ck"))
    assert read_deliveries(spark, on_time).count() == 1000 and read_deliveries(spark, late).count() == 0


def test_stream_join_equals_batch(spark, ordered, tmp_path):
    def sides(df):
        return (df.filter("source = 'click'").select("entity_key", "ts", "obs_id"),
                df.filter("source = 'purchase'").select("entity_key", "ts", "obs_id"))

    a, b = sides(as_obs(event_stream(spark, ordered)))
    q = run_available(interval_correlate(a, b, "entity_key", "ts", 3600, 7200, watermark="3 hours"),
                      str(tmp_path / "out"), str(tmp_path / "ck"))
    assert dropped_rows(q) == 0
    a, b = sides(as_obs(events(spark, SF)))
    want = interval_correlate(a, b, "entity_key", "ts", 3600, 7200)
    assert rows(spark.read.parquet(str(tmp_path / "out")), "obs_id", "right_obs_id") == rows(want, "obs_id", "right_obs_id")


def test_stream_periods_and_segments_equal_batch_once_closed(spark, ordered, tmp_path):
    stream = as_obs(event_stream(spark, ordered)).withColumn("cents", F.round(F.col("speed") * 100).cast("bigint"))
    batch = as_obs(events(spark, SF)).withColumn("cents", F.round(F.col("speed") * 100).cast("bigint"))
    run_available(period_summary(stream, "ts", 7200, 3600, ["source"], "cents", watermark="1 hour"), str(tmp_path / "p"), str(tmp_path / "c1"))
    end = batch.agg(F.max("ts")).first()[0] - timedelta(hours=3)
    want = period_summary(batch, "ts", 7200, 3600, ["source"], "cents").filter(F.col("period_start") <= F.lit(end).cast("timestamp_ntz"))
    got = spark.read.parquet(str(tmp_path / "p")).withColumn("period_start", F.col("period_start").cast("timestamp_ntz"))
    assert rows(got.select(*want.columns)) == rows(want)
    run_available(session_spans(stream, "entity_key", "ts", 1800, watermark="1 hour"), str(tmp_path / "s"), str(tmp_path / "c2"))
    spans = session_spans(batch, "entity_key", "ts", 1800)
    closed = spark.read.parquet(str(tmp_path / "s"))
    assert 0 <= spans.count() - closed.count() < 20
    assert set(rows(closed, "entity_key", "n_rows")) <= set(rows(spans, "entity_key", "n_rows"))


def test_final_table_rewrites_only_what_it_is_given(spark, tmp_path):
    path = str(tmp_path / "final")
    df = events(spark, SF).withColumn("day", F.to_date("ts"))
    write_final(df, path, ["day"])
    one = df.filter("day = '2024-01-03'").withColumn("value", F.lit(0.0))
    for _ in range(2):
        write_final(one, path, ["day"])
    got = spark.read.parquet(path)
    assert got.count() == 1000 and got.filter("value = 0.0 AND day = '2024-01-03'").count() == one.count()


def test_merge_needs_partition_columns_in_the_key(spark, tmp_path):
    with pytest.raises(ValueError):
        merge_into(spark, "nowhere", events(spark, SF), ["event_id"], "ts", ["event_type"], str(tmp_path / "s"))


def test_split_is_stored_once_and_whole(spark, tmp_path):
    a, b = write_split(events(spark, SF), str(tmp_path / "split"), F.col("value") > 50)
    assert a.count() + b.count() == 1000 and a.filter("value <= 50").count() == 0 and b.filter("value > 50").count() == 0


def test_manifest_checksum_sees_changes_and_ignores_order(spark):
    df = events(spark, SF)
    total = lambda d: manifest(d, [], "b").first()["checksum"]
    base = total(df)
    assert base == total(df.orderBy("value")) == total(df.repartition(7))
    assert base != total(df.filter("event_id <> 5"))
    assert base != total(df.unionAll(df.filter("event_id = 5")))
    assert base != total(df.unionAll(df.filter("event_id = 5")).unionAll(df.filter("event_id = 5")))


def test_a_batch_delivered_again_replaces_itself(spark, tmp_path):
    out, df = str(tmp_path / "out"), events(spark, SF)
    deliver(df, out, 1)
    deliver(df.filter("event_id < 10"), out, 2)
    deliver(df, out, 1)
    assert rows(read_deliveries(spark, out).groupBy("batch_id").count()) == [("1", 1000), ("2", 10)]


def test_event_time_gap_is_exclusive_at_the_boundary(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t), (1, t + timedelta(seconds=1800))], "k long, ts timestamp")
    assert session_spans(df, "k", "ts", 1800).count() == 1


def test_counts_of_a_stream_that_crashes_and_goes_on(spark, ordered, tmp_path):
    """The third micro-batch dies after its write and is repeated: its rows count once."""
    out, seen, ck = (str(tmp_path / n) for n in ("out", "seen", "ck"))
    dies = [True]

    def sink(batch, batch_id):
        deliver(batch, out, batch_id)
        if batch_id == 2 and dies.pop():
            dies.append(False)
            raise OSError("lost")

    with pytest.raises(Exception, match="lost"), BatchCounts(spark, seen):
        run_available(counted(event_stream(spark, ordered), "in"), sink, ck)
    assert rows(read_counts(spark, seen), "batch_id") == [(0,), (1,)]
    stored = lambda: {"in": {"out": read_deliveries(spark, out)}}
    part = reconcile_stream(read_counts(spark, seen), stored()).first()
    assert not part["balanced"] and part["n_out"] > part["n_in"]
    dies[:] = [False]
    with BatchCounts(spark, seen):
        run_available(counted(event_stream(spark, ordered), "in"), sink, ck)
    want = [tuple(r) for r in read_deliveries(spark, out).groupBy(F.col("batch_id").cast("bigint")).count().collect()]
    assert rows(read_counts(spark, seen), "batch_id", "n_rows") == sorted(want)
    assert tuple(reconcile_stream(read_counts(spark, seen), stored()).first()) == ("in", 4, 0, 1000, 1000, True)


def test_a_count_that_is_missing_is_not_balanced(spark):
    seen = spark.createDataFrame([("a", 0, 5), ("a", 2, 5), ("b", 0, 1)], "stage string, batch_id long, n_rows long")
    ten, none = spark.range(10), spark.range(0)
    found = reconcile_stream(seen, {"a": {"x": ten}, "b": {"x": none}, "c": {"x": none, "y": none}})
    assert rows(found) == [("a", 2, 1, 10, 10, False), ("b", 1, 0, 1, 0, False), ("c", 0, 0, 0, 0, True)]
