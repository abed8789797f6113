"""Cases at the edges: crashes between steps, odd keys, text orders, the date line."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewright.functions.ordered import row_numbers
from tidewright.functions.skew import HotKeys
from tidewright.operators import final
from tidewright.operators.correlate import interval_correlate, proximity_pairs
from tidewright.operators.decode import reassemble_parts
from tidewright.operators.enrich import zone_containment
from tidewright.operators.final import changes, merge_into, top_n
from tidewright.operators.fuse import fuse_measurements
from tidewright.operators.ingest import dedup
from tidewright.operators.validate import check_motion
from tidewright.operators.xml import to_xml_column
from tidewright.session import exists, remove, scratch
from tidewright.sources.readers import content_id
from tidewright.sources.staged import deliver_staged, published, read_staged, sweep
from tidewright.sources.sinks import deliver, read_deliveries, write_final, write_xml, xml_ready

T0 = datetime(2024, 1, 1)
SCHEMA = "id long, p string, v long, version int"


def stored(spark):
    path, stage = scratch(spark, "final"), scratch(spark, "stage")
    write_final(spark.createDataFrame([(1, None, 1, 1), (2, None, 2, 1), (3, "007", 3, 1), (4, "7", 4, 1)], SCHEMA), path, ["p"])
    return path, stage, spark.createDataFrame([(1, None, 10, 2), (3, "007", 30, 2)], SCHEMA)


WANT = [(1, None, 10, 2), (2, None, 2, 1), (3, "007", 30, 2), (4, "7", 4, 1)]


def held(spark, path):
    return sorted(rows(spark.read.schema(SCHEMA).parquet(path), "id", "p", "v", "version"), key=lambda r: r[0])


def test_merge_keeps_null_and_numeric_looking_partitions(spark):
    path, stage, newer = stored(spark)
    for _ in range(2):
        merge_into(spark, path, newer, ["id", "p"], "version", ["p"], stage)
        assert held(spark, path) == WANT and not exists(spark, stage)


def test_merge_reads_touched_folders_only(spark, capsys):
    path, _, _ = stored(spark)
    spark.read.schema(SCHEMA).parquet(path).filter(F.col("p").eqNullSafe(F.lit("007"))).explain()
    assert "PartitionFilters: [(p#" in capsys.readouterr().out.replace("isnotnull", "")


def test_merge_is_finished_after_a_crash(spark, monkeypatch):
    """The run dies between removing the old partitions and putting in the new ones."""
    path, stage, newer = stored(spark)

    def dies(df, target, parts=(), fmt="parquet"):
        remove(spark, f"{path}/p=007")
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(final, "write_final", dies)
        with pytest.raises(OSError):
            merge_into(spark, path, newer, ["id", "p"], "version", ["p"], stage)
    assert len(held(spark, path)) == 3 and exists(spark, f"{stage}/_SUCCESS")
    merge_into(spark, path, newer, ["id", "p"], "version", ["p"], stage)
    assert held(spark, path) == WANT and not exists(spark, stage)


def test_batch_ids_stay_as_given(spark):
    path = scratch(spark, "out")
    for batch in ("001", "1"):
        deliver(spark.createDataFrame([(1, "x")], "id long, t string"), path, batch)
    assert {r.batch_id for r in read_deliveries(spark, path).collect()} == {"001", "1"}
    assert {r.batch_id for r in read_deliveries(spark, path, schema="id long, t string").collect()} == {"001", "1"}


@pytest.mark.parametrize("kind", ["string", "double", "decimal(12,3)", "date", "bigint"])
def test_row_numbers_of_hot_keys_follow_any_order(spark, kind):
    value = {"string": "cast(id * 7919 % 1000 as string)", "double": "rand(3)", "decimal(12,3)": "cast(id * 7919 % 1000 / 1000 as decimal(12,3))",
             "date": "date_add(date'2020-01-01', cast(id * 7919 % 900 as int))", "bigint": "id * 7919 % 1000"}[kind]
    df = spark.range(3000).selectExpr("id % 2 as k", f"{value} as o", "id").cache()
    plain = row_numbers(df, ["k"], ["o", "id"], "n", hot=None)
    hot = row_numbers(df, ["k"], ["o", "id"], "n", hot=HotKeys(min_rows=100, max_keys=50))
    assert rows(plain) == rows(hot)


def test_messages_lose_no_payload(spark):
    at = lambda s: T0 + timedelta(seconds=s)
    given = [("a", at(s), p, 2, x) for s, p, x in [(0, 1, "A"), (1, 2, "B"), (30, 1, "C"), (31, 2, "D"), (32, 2, "D"), (60, 1, "E"),
                                                   (90, 1, "F"), (91, 2, "G")]]
    given += [("b", at(0), 1, 2, "x"), ("b", at(0), 1, 2, "y"), ("b", at(1), 2, 2, "z"), ("c", at(0), 3, 2, "odd"), ("c", at(0), None, 2, "none")]
    df = spark.createDataFrame(given, "k string, ts timestamp, part int, n int, payload string")
    found = reassemble_parts(df, ["k"], "ts", "part", "n", "payload", 60).collect()
    assert sorted(r.payload for r in found if r.payload and r.error is None) == ["AB", "CD", "FG", "yz"]
    assert sorted(p.payload for r in found for p in r.parts) == sorted({(g[0], g[4]): g[4] for g in given}.values())
    assert {r.error for r in found if r.k == "c"} == {"bad part number"}


def test_a_message_of_many_parts(spark):
    df = spark.range(1, 10_002).selectExpr("'m' as k", "timestamp_seconds(1700000000 + id) as ts", "cast(id as int) as part",
                                           "10001 as n", "cast(id % 10 as string) as payload")
    found = reassemble_parts(df, ["k"], "ts", "part", "n", "payload", 60).collect()
    assert len(found) == 1 and found[0].error is None and len(found[0].payload) == 10_001


def test_zones_over_the_date_line(spark):
    points = spark.createDataFrame([(1, 0.0, 175.0), (2, 0.0, -175.0), (3, 0.0, 185.0), (4, 0.0, 0.0), (5, 0.0, -180.0), (6, 0.0, 180.0), (7, None, 1.0)],
                                   "obs_id long, lat double, lon double")
    ring = lambda a, b: [(a, -5.0), (b, -5.0), (b, 5.0), (a, 5.0)]
    zones = spark.createDataFrame(
        [("beyond", ring(170.0, 190.0), 170.0, 190.0, -5.0, 5.0), ("turned", ring(170.0, -170.0), 170.0, -170.0, -5.0, 5.0),
         ("plain", ring(-10.0, 10.0), -10.0, 10.0, -5.0, 5.0)],
        "zone_id string, ring array<struct<x:double,y:double>>, min_x double, max_x double, min_y double, max_y double")
    found = set(rows(zone_containment(points, zones, 100_000)))
    assert found == {(i, z) for i in (1, 2, 3, 5, 6) for z in ("beyond", "turned")} | {(4, "plain")}


def test_motion_from_the_last_known_place(spark):
    fixes = [(1, T0, 0.0, 0.0), (2, T0 + timedelta(seconds=10), None, 0.0), (3, T0 + timedelta(seconds=20), 0.0, 0.001), (4, T0 + timedelta(seconds=30), None, None)]
    df = spark.createDataFrame([("e", *f) for f in fixes], "k string, id long, ts timestamp, lat double, lon double")
    found = {r.id: r for r in check_motion(df, "k", "ts", 30.0, tie=["id"]).collect()}
    assert [found[i].prev_dist_m is None for i in (1, 2, 3, 4)] == [True, True, False, True]
    assert found[3].prev_seconds == 20 and 111 < found[3].prev_dist_m < 112
    assert not any(r.too_fast for r in found.values())


def test_small_edges(spark):
    a = spark.createDataFrame([(1, T0)], "k long, ts timestamp")
    b = spark.createDataFrame([(1, T0 + timedelta(microseconds=1_001_000))], "k long, ts timestamp")
    assert interval_correlate(a, b, "k", "ts", 0, 1.001).count() == 1
    for how in ("right", "full_outer"):
        with pytest.raises(ValueError):
            interval_correlate(a, b, "k", "ts", 0, 1, how=how)
    here = spark.createDataFrame([(1, T0, 1.0, 1.0), (2, T0, 1.0, 1.0), (3, T0 + timedelta(seconds=1), 1.0, 1.0)], "obs_id long, ts timestamp, lat double, lon double")
    assert [(r.left_id, r.right_id, r.score) for r in proximity_pairs(here, here, 0, 0, ordered=True).collect()] == [(1, 2, 1.0)]
    pair = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "c"), ("", "c"), ("\\N", "c")], "x string, y string")
    assert pair.select(content_id(["x", "y"])).distinct().count() == 5
    twice = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k long, t string")
    assert rows(dedup(twice, ["k"])) == [(1, "a"), (2, "c")]
    assert [r["rank"] for r in top_n(twice, [], ["k", "t"], 2).collect()] == [1, 2]
    times = lambda us: spark.createDataFrame([(1, T0 + timedelta(microseconds=us))], "k long, ts timestamp")
    assert rows(changes(times(123_456), times(123_999), ["k"])) == [(1, "altered")]


def test_measurements_that_are_no_numbers_do_not_count(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1), v, c) for v, c in
                                ((1.0, 90.0), (float("nan"), float("nan")), (float("inf"), float("-inf")), (1e300, 90.0), (3.0, None))],
                               "k int, ts timestamp, v double, c double")
    r = fuse_measurements(df, "k", "ts", "1 day", {"v": 0.01}, ["c"]).first()
    assert (r.n_rows, r.v, round(r.c, 6)) == (5, 2.0, 90.0)


def test_texts_that_xml_cannot_hold(spark, tmp_path):
    texts = ["plain", "a\x01b", "\x00", "tab\tline\nend", "￾￿", "🙂 é", None, "<&>\x0b\x1f"]
    clean = ["plain", "a�b", "�", "tab\tline\nend", "��", "🙂 é", None, "<&>��"]
    df = spark.createDataFrame([(k, t, [t], (t,), {"k": t}) for k, t in enumerate(texts)],
                               "id int, name string, many array<string>, one struct<x: string>, by map<string, string>")
    path = str(tmp_path / "xml")
    write_xml(df.select("id", "name"), path, "rows", "row")
    back = spark.read.format("xml").schema("id int, name string").option("rowTag", "row").option("ignoreSurroundingSpaces", "false").load(path)
    assert rows(back) == sorted(zip(range(8), clean))
    safe = xml_ready(df).collect()
    assert [(r.name, r.many, r.one.x, r.by["k"]) for r in safe] == [(t, [t], t, t) for t in clean]
    assert to_xml_column(df, ["id", "name"], "row").filter("xml is null").count() == 0


def test_a_failed_delivery_leaves_nothing(spark, tmp_path):
    import os
    path = str(tmp_path / "staged")
    good = spark.range(0, 20_000, 1, 4).withColumn("v", F.col("id") * 2)
    # one task fails after it has written most of its rows; the others may have finished
    bad = good.withColumn("v", F.when(F.col("id") == 19_999, F.raise_error("broken")).otherwise(F.col("v")).cast("long"))
    with pytest.raises(Exception):
        deliver_staged(bad, path, "a/b 1")
    assert published(path) == [] and read_staged(spark, path, "id long, v long").count() == 0
    sweep(path)  # a task that was killed while the others were being undone may have left its file
    assert [f for _, _, names in os.walk(path) for f in names] == []
    deliver_staged(good, path, "a/b 1")
    deliver_staged(good.limit(5), path, "a/b 1")  # published already
    deliver_staged(good.filter("id < 0"), path, "empty")
    back = read_staged(spark, path, "id long, v long")
    assert rows(back.select("id", "v")) == rows(good) and back.select("batch_id").distinct().collect()[0][0] == "a/b 1"
    assert [(p["batch_id"], p["rows"]) for p in published(path)] == [("a/b 1", 20_000), ("empty", 0)]
    # what a killed driver left is not read, and goes when swept
    os.makedirs(f"{path}/data/dead")
    with open(f"{path}/data/dead/x.parquet", "wb") as out:
        out.write(b"half a file")
    assert read_staged(spark, path, "id long, v long").count() == 20_000
    assert sweep(path) == 1 and sweep(path) == 0
    assert read_staged(spark, path, "id long, v long").count() == 20_000
