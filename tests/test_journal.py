"""Batch runs that die between stages, and what makes a stage run again."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewright.plans import journal
from tidewright.plans.batch import Plan, run_batch
from tidewright.plans.catalog.base import events
from tidewright.plans.catalog.whole import PLAN, named_places
from tidewright.plans.journal import Journal, content_mark, file_mark, marks, run_batch_resumed
from tidewright.session import exists, remove, scratch
from tidewright.operators.validate import Rule

SF = "/root/testdata/sf0.001"


def runs(spark, path):
    return sorted(r["stage"] for r in Journal(spark, path).entries().collect())


def test_a_run_killed_after_validation_starts_at_correlation(spark, monkeypatch):
    path, raw, places = scratch(spark, "journal"), events(spark, SF), named_places(spark, SF)

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(journal, "correlate_valid", dies)
        with pytest.raises(OSError):
            run_batch_resumed(spark, raw, places, PLAN, path)
    assert runs(spark, path) == ["decode", "validate"]
    with monkeypatch.context() as m:
        m.setattr(journal, "reports", dies)
        m.setattr(journal, "apply_rules", dies)
        found = run_batch_resumed(spark, raw, places, PLAN, path)
    want = run_batch(raw, places, PLAN)
    for name in ("rejects", "quarantine", "linked", "fused"):
        assert rows(found[name], *want[name].columns) == rows(want[name]), name


def test_a_stage_that_died_while_it_was_written_is_written_anew(spark):
    path = scratch(spark, "journal")
    held = Journal(spark, path)
    assert rows(held.table("a", "m", lambda: spark.range(5))) == [(i,) for i in range(5)]
    remove(spark, f"{path}/entries/a-m")  # the table is there, its entry is not
    assert rows(held.table("a", "m", lambda: spark.range(3))) == [(i,) for i in range(3)]


def test_a_stage_that_fails_leaves_no_entry(spark):
    held = Journal(spark, scratch(spark, "journal"))
    bad = spark.range(5).select(F.raise_error(F.lit("lost")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        held.table("a", "m", lambda: bad)
    assert held.entries().count() == 0


def test_marks_change_from_the_first_stage_that_sees_the_change():
    changed = lambda *a, **k: [s for s, m in marks(*a, **k).items() if m != marks("raw", "places", PLAN)[s]]
    later = ["enrich"]
    assert changed("raw", "other", PLAN) == later
    assert changed("raw", "places", Plan(PLAN.rules, PLAN.priority[::-1])) == (later := ["fuse", *later])
    assert changed("raw", "places", Plan(PLAN.rules, PLAN.priority, lead_source="click")) == (later := ["correlate", *later])
    assert changed("raw", "places", Plan((Rule("r", "true"),), PLAN.priority)) == (later := ["validate", *later])
    assert changed("new", "places", PLAN) == changed("raw", "places", PLAN, "2") == ["decode", *later]


def test_marks_of_inputs(spark):
    path = scratch(spark, "in")
    spark.range(10).write.parquet(path)
    read = lambda: spark.read.parquet(path)
    first = file_mark(read())
    assert file_mark(read()) == first and file_mark(read().filter("id >= 0")) == first
    spark.range(10, 11).write.mode("append").parquet(path)
    assert file_mark(read()) != first
    a = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "a long, b string")
    assert content_mark(a) == content_mark(a.repartition(3))
    assert len({content_mark(x) for x in (a, a.distinct(), a.withColumnRenamed("b", "c"), a.limit(0), a.fillna("x"))}) == 5


def test_empty_input_nulls_and_sweep(spark):
    path, places = scratch(spark, "journal"), named_places(spark, SF)
    none = events(spark, SF).limit(0)
    for _ in range(2):  # the second run reads empty tables back
        found = run_batch_resumed(spark, none, places, PLAN, path, raw_mark="none")
        assert {k: v.count() for k, v in found.items()} == dict.fromkeys(found, 0) and len(found) == 5
    odd = events(spark, SF).limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in none.schema.fields])
    found = run_batch_resumed(spark, odd, places, PLAN, path, raw_mark="odd")
    assert found["fused"].count() + found["quarantine"].count() + found["rejects"].count() == 1
    keep = marks("odd", content_mark(places), PLAN)
    assert len(Journal(spark, path).sweep(keep)) == 5
    assert runs(spark, path) == sorted(journal.STAGES)
    assert not exists(spark, f"{path}/tables/decode-{marks('none', 'x', PLAN)['decode']}")
