"""State across micro-batches: messages from parts, entities that fall silent."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from conftest import rows
from tidewright.functions.skew import HotKeys
from tidewright.operators.decode import reassemble_parts
from tidewright.plans.catalog.base import as_obs, event_stream, feed
from tidewright.session import STATE_STORE
from tidewright.streaming.run import deliver_to, run_available
from tidewright.streaming.state import (Pieces, in_order, latest_state_expiring, presence_table, read_presence,
                                        reassemble_stream)

SF = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)
PARTS = "source string, seq int, ts timestamp, part_no int, n_parts int, payload string"


def joined(df):
    return sorted(((r.source, r.seq, r.n_parts, r.n_present, r.payload, r.error, tuple(tuple(p) for p in r.parts))
                   for r in df.collect()), key=str)


def test_a_number_used_again_with_the_same_first_part(spark):
    at = lambda s: START + timedelta(seconds=s)
    parts = [("a", 1, at(0), 1, 2, "P"), ("a", 1, at(1), 2, 2, "Q"), ("a", 1, at(30), 1, 2, "P"), ("a", 1, at(31), 2, 2, "R"),
             ("b", 1, at(0), 2, 2, "Q"), ("b", 1, at(1), 1, 2, "P"),                       # the wrong way round
             ("c", 1, at(0), 1, 3, "1"), ("c", 1, at(1), 2, 3, "2"), ("c", 1, at(2), 1, 3, "1"), ("c", 1, at(3), 3, 3, "3"),  # a copy
             ("d", 1, at(0), 2, 2, "Q"), ("d", 1, at(9), 1, 2, "P"), ("d", 1, at(10), 2, 2, "R"),  # a lost part spoils one message
             ("e", None, at(0), 1, 2, None), ("e", None, at(1), 2, 2, "x")]
    whole = reassemble_parts(spark.createDataFrame(parts, PARTS), ["source", "seq"], "ts", "part_no", "n_parts", "payload", 60)
    assert sorted(((r.source, r.payload, r.error) for r in whole.collect()), key=str) == [
        ("a", "PQ", None), ("a", "PR", None), ("b", "PQ", None), ("c", "123", None), ("d", "PR", None), ("d", None, "incomplete"),
        ("e", "x", None)]


def random_parts(seed, n_keys=40, n_rows=40):
    rng = random.Random(seed)
    out = []
    for key in range(n_keys):
        t, n = 0.0, rng.choice([2, 2, 3, 4])
        for _ in range(rng.randint(1, n_rows)):
            t += rng.choice([0, 0.5, 1, 2, 5, 25])
            out.append((f"s{key % 3}", key, START + timedelta(seconds=t), rng.randint(1, n), n, rng.choice(["x", "y", "z", None])))
    return out


def plain_messages(parts, gap):
    out = []
    for key in sorted({(p[0], p[1], p[4]) for p in parts}):
        mine = sorted(((round((p[2] - START).total_seconds() * 1e6), p[3], p[5]) for p in parts if (p[0], p[1], p[4]) == key), key=in_order)
        pieces = Pieces(key[2], gap * 1_000_000)
        for part in mine:
            pieces.take(part)
        pieces.close()
        out += [(*key, m[2], m[3], m[5], tuple((r.part_no, r.payload) for r in m[4])) for m in pieces.told]
    return sorted(out, key=str)


def test_messages_beside_taking_part_by_part(spark):
    for seed, hot in ((1, None), (2, HotKeys(min_rows=15, max_keys=50))):
        parts = random_parts(seed)
        df = spark.createDataFrame(parts, PARTS).repartition(3)
        whole = reassemble_parts(df, ["source", "seq"], "ts", "part_no", "n_parts", "payload", 20, hot=hot)
        assert joined(whole) == plain_messages(parts, 20)


def test_no_payload_is_lost(spark):
    parts = [(s, k, t, p, n, f"{i}") for i, (s, k, t, p, n, _) in enumerate(random_parts(3))]
    whole = reassemble_parts(spark.createDataFrame(parts, PARTS), ["source", "seq"], "ts", "part_no", "n_parts", "payload", 20)
    assert sorted(r[0] for r in whole.select(F.explode("parts.payload")).collect()) == sorted(p[5] for p in parts)


def write_part(spark, path, number, rows_, schema):
    import os
    spark.createDataFrame(rows_, schema).coalesce(1).write.parquet(f"{path}/t{number}")
    for name in os.listdir(f"{path}/t{number}"):
        if name.startswith("part-"):
            os.utime(f"{path}/t{number}/{name}", (1_700_000_000 + 60 * number,) * 2)


def test_messages_of_a_stream_stopped_and_resumed(spark, tmp_path):
    parts = sorted(random_parts(4, n_keys=8, n_rows=25), key=lambda p: p[2])
    late = START + timedelta(hours=2)
    parts.append(("end", 0, late, 1, 1, "end"))
    cut = len(parts) // 3
    sets = [parts[:cut], parts[cut:2 * cut], parts[2 * cut:]]
    rng = random.Random(1)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    for k, some in enumerate(sets):  # one file arrives, the query runs and stops
        rng.shuffle(some)
        write_part(spark, str(tmp_path / "feed"), k, some, PARTS)
        stream = spark.readStream.schema(PARTS).parquet(str(tmp_path / "feed") + "/t*")
        whole = reassemble_stream(stream, ["source", "seq"], "ts", "part_no", "n_parts", "payload", 20, "100 seconds")
        run_available(whole, deliver_to(out), checkpoint)
    got = spark.read.parquet(f"{out}/batch_id=*").filter("source <> 'end'")
    assert joined(got) == plain_messages(parts[:-1], 20)


def test_entities_leave_the_state_whatever_the_batches(spark, tmp_path):
    stream = lambda files: as_obs(event_stream(spark, path, files))
    path = feed(spark, SF)
    results = []
    for files in (1, 4):
        out, checkpoint = str(tmp_path / f"out{files}"), str(tmp_path / f"ck{files}")
        done = presence_table(stream(files), "entity_key", "ts", 86_400, "1 hour", ["obs_id"], out, checkpoint)
        live, lost = read_presence(spark, out, "entity_key", "ts", ["obs_id"])
        results.append((rows(live), rows(lost)))
        # one row per entity still there, one timer each, and what the delay holds
        kept = [op.numRowsTotal for p in done.recentProgress for op in p.stateOperators][-1]
        assert kept <= 6 * 15
    assert results[0] == results[1] and results[0][1]


def test_rows_out_of_order_within_the_delay(spark, tmp_path):
    schema = "k int, ts timestamp, v int"
    at = lambda s: datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=s)
    write_part(spark, str(tmp_path / "feed"), 0, [(1, at(50), 2), (1, at(0), 1), (2, at(10), 1), (None, at(1), 9), (3, None, 9)], schema)
    write_part(spark, str(tmp_path / "feed"), 1, [(1, at(30), 3), (2, at(100), 2), (9, at(500), 0)], schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "feed") + "/t*")
    told = latest_state_expiring(stream, "k", "ts", 40, "60 seconds", ["v"])
    run_available(told, deliver_to(str(tmp_path / "out")), str(tmp_path / "ck"))
    live, lost = read_presence(spark, str(tmp_path / "out"), "k", "ts", ["v"])
    # 0 to 30 to 50 is never silent for over 40 s: the row at 30 came late but within the delay
    assert rows(lost, "k", "v") == [(1, 2), (2, 1), (2, 2)] and rows(live, "k", "v") == [(9, 0)]


def test_sentences_of_a_stream_killed_and_resumed(spark, tmp_path):
    """The last micro-batch is written, its commit is not: the run that follows does it again."""
    import os

    from tidewright.operators.validate import Rule
    from tidewright.plans.catalog.sentences import SOURCES, position_lines, sentence, static_lines
    from tidewright.plans.sentences import run_sentence_stream, sentence_picture, stored_sentences

    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    odd = spark.createDataFrame([("odd", 1_704_500_000, "!AIVDM,1,1,,A,x*00"), ("odd", 1_704_500_001, "nothing"), ("odd", 1_704_500_002, None)],
                                "source string, at long, raw string").select("source", F.timestamp_seconds("at").alias("received_ts"), "raw")
    fields = odd.limit(1).select("source", "received_ts", sentence(F.lit("17~"), 2, 3, F.lit("1")).alias("raw")).unionByName(
        odd.limit(1).select("source", "received_ts", sentence(F.lit("17~")).alias("raw")))
    lines = position_lines(spark, SF).unionByName(static_lines(spark, SF)).unionByName(odd).unionByName(fields)
    end = lines.agg((F.max("received_ts") + F.expr("interval 1 day")).alias("received_ts")).select(
        F.lit("clock").alias("source"), "received_ts", sentence(F.lit("4" + "0" * 27)).alias("raw"))
    lines = sorted(map(tuple, lines.unionByName(end).select("source", "received_ts", "raw").collect()), key=lambda r: r[1])
    schema = "source string, received_ts timestamp, raw string"
    third = len(lines) // 3
    rules = [Rule("north", "lat > -60"), Rule("slow", "speed < 50", "warning")]
    for k in range(3):
        part = lines[k * third:(k + 1) * third if k < 2 else None]
        write_part(spark, str(tmp_path / "feed"), k, part, schema)
        for again in (False, True):
            stream = spark.readStream.schema(schema).parquet(str(tmp_path / "feed") + "/t*")
            run_sentence_stream(stream, out, checkpoint, rules, 50)
            if not again:
                last = max((n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()), key=int)
                for name in (last, f".{last}.crc"):
                    if os.path.exists(f"{checkpoint}/commits/{name}"):
                        os.unlink(f"{checkpoint}/commits/{name}")
    whole = sentence_picture(spark.createDataFrame(lines, schema), rules, SOURCES, 50)
    found = stored_sentences(spark, out, SOURCES)
    assert rows(found["fused"]) == rows(whole["fused"]) and whole["fused"].count() == 15
    for side, cols in (("rejects", ["source", "stage", "text", "error"]), ("quarantine", ["obs_id", "entity_key", "lat", "violations"]),
                       ("static", ["entity_key", "valid_from", "name", "kind", "length", "width"]), ("other", ["source", "payload", "msg_type"])):
        assert rows(found[side], *cols) == rows(whole[side], *cols), side
    assert {r.stage for r in found["rejects"].collect()} == {"integrity", "reassembly", "type"}


def test_states_of_a_session_built_elsewhere(spark, tmp_path):
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    kept = spark.conf.get(STATE_STORE)
    data = str(tmp_path / "in")
    write_part(spark, data, 0, [("a", 1, START, 1, 2, "P"), ("a", 1, START, 2, 2, "Q"), ("b", 1, START, 1, 1, "R"),
                                ("z", 1, START + timedelta(hours=1), 1, 1, "S")], PARTS)
    spark.conf.set(STATE_STORE, default)
    try:
        feed = spark.readStream.schema(PARTS).parquet(data + "/t*")
        run_available(reassemble_stream(feed, ["source", "seq"], "ts", "part_no", "n_parts", "payload", 60, "1 minute"),
                      deliver_to(str(tmp_path / "out")), str(tmp_path / "ck"))
    finally:
        spark.conf.set(STATE_STORE, kept)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert rows(out, "source", "payload") == [("a", "PQ"), ("b", "R"), ("z", "S")]


def test_a_feed_of_many_rows_has_more_files(spark, monkeypatch):
    from tidewright.plans.catalog import base
    monkeypatch.setattr(base, "FILE_ROWS", 100)
    given = spark.range(1000).select("id", F.timestamp_seconds(F.col("id") * 37 % 1000).alias("ts"))
    path = base.feed_of(spark, given, "ts")
    read = spark.read.parquet(path).withColumn("file", F.input_file_name())
    sizes = [r["count"] for r in read.groupBy("file").count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 150 and rows(read, "id", "ts") == rows(given)


def test_parts_of_many_messages_go_to_tasks_of_bounded_size(spark, monkeypatch):
    from tidewright.operators import decode
    parts = random_parts(6)
    given = spark.createDataFrame(parts, PARTS)
    args = ["source", "seq"], "ts", "part_no", "n_parts", "payload", 20
    plain = reassemble_parts(given, *args)
    monkeypatch.setattr(decode, "TASK_ROWS", 50)
    spread = reassemble_parts(given, *args)
    assert joined(spread) == joined(plain) == plain_messages(parts, 20)
    several = sum(1 for p in parts if p[3] is not None and p[4] is not None and 1 <= p[3] <= p[4] and p[4] > 1)
    assert f"hashpartitioning(source#" in spread._jdf.queryExecution().executedPlan().toString()
    assert f", {-(-several // 50)}), REPARTITION_BY_NUM" in spread._jdf.queryExecution().executedPlan().toString()


class Store:
    """A state store of one entry and its timers; counts what is asked of it."""

    def __init__(self):
        self.calls, self.value, self.timers = 0, None, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)

    def getCurrentWatermarkInMs(self):
        return self.passed


def test_keys_of_a_bucket_share_one_entry_and_one_timer():
    """Asked for by key, state and timers cost several calls for each of many keys."""
    from pyspark.sql import types as T
    from tidewright.streaming.state import MARK, Assembling, Previous

    named = lambda *names: T.StructType([T.StructField(n, T.StringType()) for n in names])
    store, keys = Store(), range(200)
    store.passed = 0
    row = lambda k, us, counts="1": (7, MARK.join([counts, str(us), f"key{k}", "{}", f"b{us}", f"d{k}-{us}"]), None)
    previous = Previous(named("__bucket", "__data", "__before"), [], 1_000_000, None)
    previous.init(store)
    given = [row(k, us) for k in keys for us in (5_000_000 + k, 3_000_000 + k)]
    assert list(previous.handleInputRows((7,), iter(given), store)) == [] and store.timers == {4000}
    assert [tuple(r) for r in previous.handleInputRows((7,), iter([row(1, 9, "0")]), store)] == [(7, "d1-9", None)]
    store.passed = 10_000
    told = {tuple(r) for r in previous.handleExpiredTimer((7,), store, None)}
    assert told == {(7, f"d{k}-{3_000_000 + k}", None) for k in keys} | {(7, f"d{k}-{5_000_000 + k}", f"b{3_000_000 + k}") for k in keys}
    assert store.calls <= 8 and not store.timers

    store = Store()
    store.passed = 10
    part = lambda k, no: (7, MARK.join(["5000", "2", str(no), f"key{k}", "=\x1fp" if no == 1 else ""]), None)
    assembling = Assembling(named("__bucket", "__key", "n_parts", *"abcdefg"), 1_000_000)
    assembling.init(store)
    told = list(assembling.handleInputRows((7,), iter([part(k, no) for k in keys for no in (1, 2)]), store))
    assert len(told) == 200 and {(r[2], r[5], r[6], r[8]) for r in told} == {(2, 2, "\x1fp", None)}
    assert store.calls <= 4 and len(store.timers) == 1


def test_state_of_a_stream_goes_by_cores(spark, tmp_path):
    import json
    import os

    schema = "k int, ts timestamp, v int"
    write_part(spark, str(tmp_path / "feed"), 0, [(1, START, 1), (2, START, 1)], schema)
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "feed") + "/t*").groupBy("k").count()
    for tasks in (3, 2):  # a checkpoint keeps what it began with
        run_available(stream, lambda batch, n: batch.collect() and None, str(tmp_path / "ck"), "update", state_tasks=tasks)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    found = {json.loads(open(f"{tmp_path}/ck/offsets/{n}").read().split("\n")[1])["conf"]["spark.sql.shuffle.partitions"]
             for n in os.listdir(f"{tmp_path}/ck/offsets") if n.isdigit()}
    assert found == {"3"}


def test_odd_values_go_through_the_state_as_they_are(spark, tmp_path):
    """Keys without a value, ties of other types, instants and texts with marks."""
    from tidewright.streaming.state import previous_row_stream

    schema = "k bigint, n int, ts timestamp, w timestamp_ntz, x double, s string, c boolean, a array<string>"
    at = lambda us: datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=us)
    given = [(2**60 + 1, 1, at(7), datetime(1815, 6, 18, 1, 2, 3, 4), float("nan"), "a\x1fb\u0000\"\\é", True, ["x", None]),
             (2**60 + 1, None, at(7), None, None, None, True, None), (2**60, 1, at(9), None, float("-inf"), "", True, []),
             (None, 5, at(1), None, 0.1 + 0.2, "\x1f", True, ["\x1f"]), (None, 6, at(2), None, -0.0, "t", None, None)]
    write_part(spark, str(tmp_path / "feed"), 0, given, schema)
    write_part(spark, str(tmp_path / "feed"), 1, [(0, 0, at(10**12), None, 0.0, "end", True, None)], schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "feed") + "/t*").withWatermark("ts", "1 minute")
    told = previous_row_stream(stream, "k", "ts", ["ts", "s", "w"], "c", "ts", ["n"])
    assert told.schema["prev_w"].dataType.typeName() == "timestamp_ntz"
    run_available(told, deliver_to(str(tmp_path / "out")), str(tmp_path / "ck"))
    out = spark.read.parquet(f"{tmp_path}/out/batch_id=*")
    read = spark.createDataFrame(given, schema)
    assert str(rows(out.filter("k IS NULL OR k > 0"), *read.columns)) == str(rows(read))  # NaN is no equal of itself
    one = out.filter("n = 1 AND prev_ts IS NOT NULL").first()
    assert one.k == 2**60 + 1 and one.prev_s is None and out.filter("prev_ts IS NOT NULL").count() == 1
