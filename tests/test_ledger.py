"""The ledger beside a plain dictionary of what was delivered last."""

import random

from pyspark.sql import functions as F

from conftest import rows
from tidewright.operators.ledger import Ledger

ROWS = "record_key string, digest string"


def test_beside_a_dictionary(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"), ranges=8, fold_share=0.5)
    rng, live = random.Random(1), {}
    for batch in range(6):
        table = {f"k{rng.randrange(60)}": f"d{rng.randrange(4)}" for _ in range(rng.choice([0, 20, 60]))}
        df = spark.createDataFrame(list(table.items()), ROWS)
        changed = ledger.changes(df, f"b{batch}")
        want = {(k, live.get(k), table.get(k)) for k in live.keys() | table.keys() if live.get(k) != table.get(k)}
        assert {(r.record_key, r.old, r.new) for r in changed.collect()} == want
        part = changed.filter("record_key <> 'k7'")  # one is never delivered
        for _ in range(1 + batch % 2):  # entered again after a crash
            ledger.record(part, f"b{batch}")
        for k, _, new in want:
            if k != "k7":
                live.pop(k, None) if new is None else live.__setitem__(k, new)
        assert dict(rows(ledger.live(), "record_key", "digest")) == live
    assert ledger._version()[0] > 0  # it has been folded


def test_only_touched_ranges_are_read(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"), ranges=64, fold_share=0.9)
    table = spark.range(5_000).select(F.col("id").cast("string").alias("record_key"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    ledger.record(ledger.changes(table, "b0"), "b0")
    altered = table.withColumn("digest", F.when(F.col("record_key") == "17", F.lit("new")).otherwise(F.col("digest")))
    ranges = ledger.touched(altered)
    assert len(ranges) == 1
    assert len(ledger.entries().inputFiles()) >= 64
    read = ledger.entries(ranges)
    assert read.select(F.input_file_name()).distinct().count() == 1  # one file of 64
    assert 0 < read.count() < 400
    assert rows(ledger.changes(altered, "b1"), "record_key", "new") == [("17", "new")]
    assert ledger.touched(table) == []


def test_a_batch_that_died_before_its_sums_does_not_count(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"), ranges=4)
    one = spark.createDataFrame([("a", "1"), ("b", "1")], ROWS)
    ledger.record(ledger.changes(one, "b0"), "b0")
    two = spark.createDataFrame([("a", "2")], ROWS)
    changed = ledger.changes(two, "b1")
    ledger._write(changed.select("record_key", F.col("new").alias("digest"), F.current_timestamp().alias("delivered_ts"),
                                 F.lit(2).cast("bigint").alias("seq"), "range"), "delta/batch_id=b1", by_range=True)
    assert dict(rows(ledger.live(), "record_key", "digest")) == {"a": "1", "b": "1"}
    again = ledger.changes(two, "b1")
    assert {(r.record_key, r.old, r.new) for r in again.collect()} == {("a", "1", "2"), ("b", "1", None)}
    ledger.record(again, "b1")
    assert dict(rows(ledger.live(), "record_key", "digest")) == {"a": "2"}
