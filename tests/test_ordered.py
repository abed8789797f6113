"""Order-dependent operators give the same rows with and without hot keys, and
whatever the order of the input."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewright.functions.ordered import CHUNK, OrderedCut, row_numbers
from tidewright.functions.skew import HotKeys, heavy_keys, unique_lookup
from tidewright.operators.correlate import asof_attach, session_spans, sessions
from tidewright.operators.enrich import lookup_valid_time
from tidewright.operators.fuse import resample
from tidewright.operators.validate import check_motion, check_unique
from tidewright.operators.xml import xml_documents

HOT = HotKeys(min_rows=15, max_keys=50)


@pytest.fixture(scope="module")
def fixes(spark):
    """One entity holds most rows, some times repeat, one key is null."""
    rng, start = random.Random(5), datetime(2024, 1, 1)
    data = []
    for i in range(900):
        key = 1 if i % 3 else rng.choice([2, 3, 4, None])
        data.append((i, key, start + timedelta(seconds=rng.randrange(0, 40_000, 50)),
                     rng.choice(["a", "b"]), rng.uniform(-90, 90), rng.uniform(-180, 180), round(rng.uniform(0, 9), 2)))
    rng.shuffle(data)
    return spark.createDataFrame(data, "obs_id long, entity_key long, ts timestamp, source string, lat double, lon double, speed double").cache()


def both(fn):
    return rows(fn(HotKeys())), rows(fn(HOT)), rows(fn(None))


def test_hot_keys_are_really_cut(fixes):
    cut = OrderedCut(fixes, ["entity_key"], "ts", HOT)
    sizes = [r["count"] for r in cut.assign(fixes, "ts").filter("entity_key = 1").groupBy(CHUNK).count().collect()]
    assert len(sizes) > 20 and max(sizes) < 60
    assert heavy_keys(fixes, ["entity_key"], HOT)[0]["entity_key"] == 1


@pytest.mark.parametrize("fn", [
    lambda d, h: sessions(d, "entity_key", "ts", 200, ["obs_id"], h),
    lambda d, h: session_spans(d, "entity_key", "ts", 200, ["obs_id"], hot=h),
    lambda d, h: check_motion(d, "entity_key", "ts", 1000.0, tie=["obs_id"], hot=h),
    lambda d, h: resample(d, "entity_key", "ts", 300, ["speed"], "linear", tie=["obs_id"], hot=h),
    lambda d, h: asof_attach(d.filter("source = 'a'"), d.filter("source = 'b'"), ["entity_key"], "ts",
                             ["obs_id", "speed"], tie=["obs_id"], hot=h),
    lambda d, h: row_numbers(d, ["entity_key"], ["ts", "obs_id"], "n", h),
    lambda d, h: xml_documents(d, ["source"], ["ts", "obs_id"], ["obs_id", "speed"], "r", "x", 40, h),
], ids=["sessions", "session_spans", "check_motion", "resample", "asof_attach", "row_numbers", "xml_documents"])
def test_same_rows_however_hot(fixes, fn):
    plain, cut, unchecked = both(lambda h: fn(fixes, h))
    assert plain and plain == cut == unchecked
    assert rows(fn(fixes.orderBy("speed"), HOT)) == plain


def test_cut_points_can_be_shared(fixes):
    cut = OrderedCut(fixes, ["entity_key"], "ts", HOT)
    assert rows(sessions(fixes, "entity_key", "ts", 200, ["obs_id"], cut)) == rows(sessions(fixes, "entity_key", "ts", 200, ["obs_id"]))


def test_asof_against_brute_force(fixes):
    data = [r.asDict() for r in fixes.collect()]
    want = []
    for a in (d for d in data if d["source"] == "a"):
        before = [b for b in data if b["source"] == "b" and a["entity_key"] is not None
                  and b["entity_key"] == a["entity_key"] and b["ts"] <= a["ts"]]
        last = max(before, key=lambda b: (b["ts"], b["obs_id"])) if before else None
        if last and (a["ts"] - last["ts"]).total_seconds() > 300:
            last = None
        want.append((a["obs_id"], last and last["obs_id"]))
    got = asof_attach(fixes.filter("source = 'a'"), fixes.filter("source = 'b'"), ["entity_key"], "ts", ["obs_id"],
                      tolerance=300, tie=["obs_id"], hot=HOT)
    assert rows(got, "obs_id", "right_obs_id") == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_empty_input(spark, fixes):
    none = fixes.limit(0)
    assert sessions(none, "entity_key", "ts", 200, ["obs_id"], HOT).count() == 0
    assert asof_attach(none, none, ["entity_key"], "ts", ["speed"], hot=HOT).count() == 0
    got = asof_attach(fixes, none, ["entity_key"], "ts", ["speed"], hot=HOT)
    assert got.count() == fixes.count() and got.filter("right_speed IS NOT NULL").count() == 0


def test_repeated_keys_with_nulls(fixes):
    got = check_unique(fixes, ["entity_key"], hot=HOT)
    assert got.count() == 900 and got.filter("is_repeated").count() == 900
    assert check_unique(fixes, ["obs_id"]).filter("is_repeated").count() == 0


def test_lookup_of_a_hot_key_without_broadcast(spark, fixes):
    ref = spark.createDataFrame([(1, "one"), (2, "two"), (9, "nine")], "entity_key long, name string")
    plain = unique_lookup(fixes, ref, ["entity_key"], hot=HOT)
    split = unique_lookup(fixes, ref, ["entity_key"], hot=HOT, small=False)
    assert rows(plain) == rows(split) and plain.count() == 900
    for how in ("inner", "left_anti"):
        assert rows(unique_lookup(fixes, ref, ["entity_key"], how, HOT)) == rows(
            unique_lookup(fixes, ref, ["entity_key"], how, HOT, small=False))


def test_null_safe_lookup_of_hot_keys(fixes):
    ref = fixes.groupBy("entity_key").agg(F.count(F.lit(1)).alias("n"))
    small = unique_lookup(fixes, ref, ["entity_key"], hot=HOT, null_safe=True)
    split = unique_lookup(fixes, ref, ["entity_key"], hot=HOT, null_safe=True, small=False)
    assert rows(small) == rows(split) and split.filter("n IS NULL").count() == 0


def test_valid_time_periods(spark):
    t = lambda d: datetime(2024, 1, d)
    ref = spark.createDataFrame([(1, t(1), t(5), "a"), (1, t(5), t(7), "b"), (1, t(10), None, "c")],
                                "key long, valid_from timestamp, valid_to timestamp, v string")
    asked = spark.createDataFrame([(1, t(1)), (1, t(5)), (1, t(8)), (1, t(11)), (2, t(2)), (None, t(2))], "key long, ts timestamp")
    got = lookup_valid_time(asked, ref, "key", "ts", ["v"])
    assert rows(got, "key", "v") == [(None, None), (1, None), (1, "a"), (1, "b"), (1, "c"), (2, None)]
    with pytest.raises(ValueError, match="overlap"):
        lookup_valid_time(asked, ref.unionAll(spark.createDataFrame([(1, t(6), t(9), "x")], ref.schema)), "key", "ts", ["v"])


def test_sessions_end_only_past_the_gap(spark):
    t = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    df = spark.createDataFrame([(1, t(0)), (1, t(100)), (1, t(200)), (1, t(301))], "k long, ts timestamp")
    assert rows(session_spans(df, "k", "ts", 100).select(F.col("n_rows"))) == [(1,), (3,)]
