import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewright import session
from tidewright.functions.skew import HotKeys
from tidewright.operators.final import changes, changes_blocks, merge_sketches, period_sketch, read_sketches, sketch_panes, period_summary, row_changes, top_n, upsert_final
from tidewright.operators import fuse
from tidewright.operators.fuse import conflicts, fuse_attributes, fuse_measurements, resample
from tidewright.operators.ingest import dedup, source_inventory
from tidewright.operators.normalize import normalize_time
from tidewright.operators.validate import Rule, apply_rules, reconcile, split_quarantine, watch
from tidewright.operators.xml import to_xml_column, xml_documents, xml_documents_by_bytes
from tidewright.plans.batch import Plan, publish, run_batch, store
from tidewright.plans.catalog.base import events, obs
from tidewright.plans.catalog.whole import PLAN, named_places
from tidewright.plans.stream import run_stream, stored_picture

SF = "/root/testdata/sf0.001"


def test_top_rows_beyond_the_group_limit(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 4).alias("g"))
    got = top_n(df, ["g"], [F.desc("id")], 1200)
    want = {}
    for r in df.orderBy(F.desc("id")).collect():
        want.setdefault(r.g, []).append(r.id)
    assert {g: sorted(r.id for r in got.collect() if r.g == g) for g in want} == {g: sorted(v[:1200]) for g, v in want.items()}
    assert sorted(r["rank"] for r in got.filter("g = 0").collect()) == list(range(1, 1201))


def test_changes_tell_null_from_value_and_cover_both_sides(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, None, 1), (4, "", 1)], "k long, x string, y long")
    new = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, None, 1), (5, "n", 0)], "k long, x string, y long")
    assert rows(changes(old, new, ["k"])) == [(2, "altered"), (3, "removed"), (4, "altered"), (5, "added")]
    assert rows(row_changes(old, new), "k", "n_added") == [(2, -1), (2, 1), (3, -1), (4, -1), (4, 1), (5, 1)]
    assert rows(changes(old, old, ["k"])) == []


def test_upsert_keeps_the_newest_and_prefers_the_change(spark):
    schema = "k long, v string, version int"
    cur = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (3, "c", 1)], schema)
    new = spark.createDataFrame([(1, "A", 1), (2, "old", 4), (4, "d", 1)], schema)
    assert rows(upsert_final(cur, new, ["k"], "version"), "k", "v") == [(1, "A"), (2, "b"), (3, "c"), (4, "d")]


def test_sliding_periods_against_brute_force(spark):
    t0 = datetime(2024, 1, 1)
    data = [(t0 + timedelta(seconds=37 * i), i) for i in range(200)]
    got = period_summary(spark.createDataFrame(data, "ts timestamp, v long"), "ts", 600, 200, value="v")
    want = {}
    for ts, v in data:
        first = ts - timedelta(seconds=(ts - t0).total_seconds() % 200)
        for k in range(3):
            want.setdefault(first - timedelta(seconds=200 * k), []).append(v)
    assert {tuple(r) for r in got.collect()} == {(s, len(v), sum(v), min(v), max(v)) for s, v in want.items()}
    assert got.count() == len(want)
    with pytest.raises(ValueError):
        period_summary(got.withColumn("ts", F.col("period_start")), "ts", 600, 250)


def test_sketch_is_near_the_exact_answer(spark):
    exact = obs(spark, SF).groupBy("source").agg(F.countDistinct("entity_key").alias("n"))
    got = period_sketch(obs(spark, SF), "ts", 86400 * 365, ["source"], "entity_key", "speed")
    both = got.groupBy("source").agg(F.max("n_entities").alias("m")).join(exact, "source")
    assert all(abs(r.m - r.n) <= 1 for r in both.collect())


def test_fusion_by_priority_recency_and_id(spark):
    t = lambda d: datetime(2024, 1, d)
    df = spark.createDataFrame([(1, "radar", t(9), 7, "x", None), (1, "ais", t(1), 1, "y", 1.0), (1, "ais", t(2), 2, None, 2.0),
                                (1, "ais", t(1), 3, "z", 3.0), (2, "new", t(1), 1, "w", None)],
                               "k long, source string, ts timestamp, obs_id long, name string, v double")
    for order in ("obs_id", "ts"):
        got = fuse_attributes(df.orderBy(order), "k", ["name", "v"], ["ais", "radar"])
        assert rows(got) == [(1, "z", "ais", 2.0, "ais"), (2, "w", "new", None, None)]


def test_circular_mean_goes_over_north(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1), 350.0, 1.0, 1), (1, datetime(2024, 1, 1), 10.0, None, 1),
                                (2, datetime(2024, 1, 1), 0.0, 1.0, 3), (2, datetime(2024, 1, 1), 90.0, 2.0, 1)],
                               "k long, ts timestamp, course double, v double, w int")
    got = {r.k: (round(r.course, 3) % 360, r.v) for r in fuse_measurements(df, "k", "ts", "1 day", {"v": 0.01}, ["course"], "w").collect()}
    assert got[1] == (0.0, 1.0) and got[2] == (18.435, 1.25)


def test_conflicts_count_values_not_rows(spark):
    df = spark.createDataFrame([(1, "a", "x", 1), (1, "b", "y", 1), (1, "b", "y", 1), (2, "a", "x", 1), (2, "b", None, 1)],
                               "k long, source string, name string, kind int")
    assert rows(conflicts(df, "k", ["name", "kind"])) == [(1, "name", 2, 3, "x", "y", "a", "b")]


def test_null_predicates_count_as_broken(spark):
    rules = [Rule("low", "v > 1"), Rule("odd", "v % 2 = 1", "warning")]
    df = apply_rules(spark.createDataFrame([(3,), (2,), (1,), (None,)], "v int"), rules)
    assert [r.violations for r in df.collect()] == [[], ["odd"], ["low"], ["low", "odd"]]
    valid, held = split_quarantine(df, rules)
    assert (valid.count(), held.count()) == (2, 2)
    assert rows(reconcile({"rules": (df, {"valid": valid, "held": held}), "lost": (df, {"valid": valid})})) == [
        ("lost", 4, 2, False), ("rules", 4, 4, True)]


def test_watching_counts_rows_of_a_job_that_runs_anyway(spark):
    df, seen = watch(events(spark, SF), "in")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["n_rows"] == 1000


def test_dedup_of_a_key_with_most_copies(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 != 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    got = dedup(df, ["text"], ["id"])
    assert got.count() == 1001 and got.filter("text = 'same'").first().id == 1
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_inventory_checksum_is_order_free(spark):
    df = events(spark, SF)
    a = source_inventory(df, ["event_type"], "ts", "user_id")
    assert rows(a) == rows(source_inventory(df.orderBy("value"), ["event_type"], "ts", "user_id"))
    assert rows(a) != rows(source_inventory(df.filter("event_id > 0"), ["event_type"], "ts", "user_id"))


def test_time_texts(spark):
    df = spark.createDataFrame([("2024-07-01 12:00:00",), ("01/07/2024 12:00",), ("2024-07-01T12:00:00Z",), ("noon",), (None,)], "t string")
    got = normalize_time(df, "t", ["yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm", "yyyy-MM-dd'T'HH:mm:ssXXX"], "Europe/Paris", "at")
    at = [r.at for r in got.select(F.col("at").cast("string")).collect()]
    assert at == ["2024-07-01 10:00:00", "2024-07-01 10:00:00", "2024-07-01 12:00:00", None, None]


def test_xml_escapes_and_leaves_out_nulls(spark):
    df = spark.createDataFrame([(1, "a<b & \"c\"", None), (2, None, 1.5)], "id long, name string, v double")
    got = [r.xml for r in to_xml_column(df, ["id", "name", "v"], "report").collect()]
    assert got == ['<report><id>1</id><name>a&lt;b &amp; "c"</name></report>', "<report><id>2</id><v>1.5</v></report>"]


def test_documents_hold_every_row_once(spark):
    got = xml_documents(obs(spark, SF), ["source"], ["ts", "obs_id"], ["obs_id"], "reports", "report", 30)
    assert got.agg(F.sum("n_rows")).first()[0] == 1000 and got.agg(F.max("n_rows")).first()[0] == 30
    tags = got.select(F.sum(F.size(F.split("document", "<report>")) - 1)).first()[0]
    assert tags == 1000


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Context:
        master, applicationId = "yarn", "app-1"

    class Session:
        sparkContext, conf = Context, {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(Session)
    Session.conf = {"spark.checkpoint.dir": "hdfs://shared/"}
    assert session.shared_root(Session) == "hdfs://shared"
    Context.master, Session.conf = "local[2]", {}
    assert session.shared_root(Session) == session.shared_root(Session)


def test_stream_run_gives_the_batch_result(spark, tmp_path):
    path, out = str(tmp_path / "feed"), str(tmp_path / "out")
    raw = events(spark, SF)
    raw.filter("event_id % 2 = 1").coalesce(1).write.parquet(path)
    stream = lambda: spark.readStream.schema(raw.schema).parquet(path)
    run_stream(stream(), PLAN, out, str(tmp_path / "ck"))
    raw.filter("event_id % 2 = 0").coalesce(1).write.mode("append").parquet(path)  # the rest, out of order
    for _ in range(2):
        run_stream(stream(), PLAN, out, str(tmp_path / "ck"))
    places = named_places(spark, SF)
    assert rows(stored_picture(spark, out, places, PLAN)["fused"]) == rows(run_batch(raw, places, PLAN)["fused"])


def test_publish_sends_what_is_new_and_holds_back_what_breaks_the_contract(spark, tmp_path):
    final, out = str(tmp_path / "final"), str(tmp_path / "out")
    fused = run_batch(events(spark, SF), named_places(spark, SF), Plan(priority=("view",)))["fused"].cache()
    broken = fused.withColumn("last_ts", F.when(F.col("entity_key") != 3, F.col("last_ts")))
    store(broken, final)
    publish(spark, final, out, "b1")
    sent = lambda b: spark.read.parquet(f"{out}/xml/batch_id={b}").count()
    assert sent("b1") == fused.count() - 1 and spark.read.parquet(f"{out}/refused/batch_id=b1").count() == 1
    store(fused, final)
    publish(spark, final, out, "b2")
    assert sent("b2") == 1
    publish(spark, final, out, "b2")
    assert sent("b2") == 1
    assert spark.read.parquet(f"{out}/manifest/batch_id=b1").first()["n_rows"] == fused.count() - 1


def test_one_altered_row_costs_its_block(spark):
    old = spark.range(200_000).select("id", (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("t"))
    new = old.withColumn("v", F.when(F.col("id") == 77, 99).otherwise(F.col("v"))).filter("id <> 5")
    found = changes_blocks(old, new, ["id"])
    assert rows(found) == [(5, "removed"), (77, "altered")]
    assert rows(changes_blocks(old, old, ["id"])) == []
    # rows that reach the join of whole rows: those of two blocks
    plan = found._jdf.queryExecution()
    assert "LeftSemi" in plan.toString()
    alike = spark.createDataFrame([(None, 1), (1, None), (2, 2)], "k int, v int")
    other = spark.createDataFrame([(None, 2), (1, None), (3, 2)], "k int, v int")
    assert rows(changes_blocks(alike, other, ["k"])) == rows(changes(alike, other, ["k"]))


def test_panes_merge_to_the_sketch_of_all(spark):
    start = datetime(2024, 1, 1)
    df = spark.range(20_000).select((F.col("id") % 3).alias("d"), (F.lit(start) + F.make_dt_interval(secs=F.col("id") * 10)).alias("ts"),
                                    (F.col("id") * 7919 % 5000).alias("e"), (F.col("id") * 31 % 1000).cast("double").alias("v"))
    panes = sketch_panes(df, "ts", 600, ["d"], "e", "v")
    twice = panes.unionByName(panes)  # a pane told twice counts its rows twice, its entities once
    day, again = (read_sketches(merge_sketches(p, 600, 86_400)).orderBy("period_start").collect() for p in (panes, twice))
    exact = df.groupBy(F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n"), F.countDistinct("e").alias("e")).orderBy("w").collect()
    for a, b, x in zip(day, again, exact):
        assert a.n_rows == x.n and b.n_rows == 2 * x.n and abs(a.n_entities - x.e) <= 0.03 * x.e and abs(b.n_entities - x.e) <= 0.03 * x.e
        assert abs(a.quantiles[0] - 500) <= 30 and abs(a.quantiles[1] - 950) <= 30
    with pytest.raises(ValueError):
        merge_sketches(panes, 600, 1000)


@pytest.mark.parametrize("hot", [None, HotKeys(min_rows=50, max_keys=20)])
def test_no_document_is_larger_than_its_bound(spark, hot):
    df = spark.range(400).select((F.col("id") % 2).alias("g"), "id", F.repeat(F.lit("é"), (F.col("id") * 7 % 60).cast("int")).alias("t"))
    found = xml_documents_by_bytes(df, ["g"], ["id"], ["id", "t"], "rows", "row", 600, hot=hot).orderBy("g", "part").collect()
    assert all(r.n_bytes == len(r.document.encode()) <= 600 for r in found) and sum(r.n_rows for r in found) == 400
    for g in (0, 1):
        text = "".join(r.document.removeprefix("<rows>").removesuffix("</rows>") for r in found if r.g == g)
        assert [int(x) for x in re.findall("<id>([0-9]+)</id>", text)] == list(range(g, 400, 2))
    with pytest.raises(ValueError):
        xml_documents_by_bytes(df, ["g"], ["id"], ["id", "t"], "rows", "row", 100, hot=hot)
    assert xml_documents_by_bytes(df.limit(0), ["g"], ["id"], ["id", "t"], "rows", "row", 100, hot=hot).count() == 0


def test_a_long_gap_is_laid_out_in_stretches(spark, monkeypatch):
    start = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, start, 1.0), (1, datetime(2024, 1, 11), 2.0), (2, start, 5.0), (2, start, 6.0), (3, None, 1.0)],
                               "k long, ts timestamp, v double").withColumn("i", F.monotonically_increasing_id())
    whole = resample(df.filter("k = 1"), "k", "ts", 1, ["v"], "linear")
    assert whole.count() == whole.distinct().count() == 10 * 86_400 + 1
    want = rows(resample(df, "k", "ts", 3600, ["v"], "linear", tie=["i"]))
    for points in (1, 7):
        monkeypatch.setattr(fuse, "GRID_ROWS", points)
        assert rows(resample(df, "k", "ts", 3600, ["v"], "linear", tie=["i"])) == want
