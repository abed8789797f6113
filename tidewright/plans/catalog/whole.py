"""All stages in one: events to one record per entity, stored, and published."""

from pyspark.sql import functions as F

from ...operators.decode import route_rejects, split_fields
from ...operators.validate import Rule, reconcile_stream
from ...session import scratch
from ...sources.sinks import XML_TIMES, read_deliveries
from ...streaming.run import BatchCounts, counted, deliver_to, read_counts, run_available
from ..batch import ENTITY, Plan, publish, run_batch, store
from ..journal import Journal, run_batch_resumed
from ..stream import run_stream, stored_picture
from .base import event_stream, events, feed, query, table
from .decode import LINE, broken

PLAN = Plan(
    rules=(Rule("speed_high", "speed < 200.0"), Rule("k_known", "k IS NOT NULL"),
           Rule("slow", "speed >= 1.0", "warning")),
    priority=("purchase", "signup", "click", "view"))


def named_places(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity_key"), F.col("c_name").alias("name"), "c_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    return c.join(n, "c_nationkey", "left").drop("c_nationkey")


PICTURE = """
    WITH valid AS (SELECT event_id, user_id, event_type, ts, value FROM events
                   WHERE value < 200.0 AND json_extract(props, '$.k') IS NOT NULL),
    best AS (SELECT user_id, value, event_type FROM valid QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY
               coalesce(list_position(['purchase', 'signup', 'click', 'view'], event_type), 5), ts DESC, event_id DESC) = 1),
    seen AS (SELECT user_id, max(ts) AS last_ts, count(*) AS n_reports FROM valid GROUP BY 1),
    linked AS (SELECT a.user_id, epoch_us(a.ts) - epoch_us(b.ts) AS us
               FROM (SELECT * FROM valid WHERE event_type = 'click') a
               ASOF JOIN (SELECT * FROM valid WHERE event_type = 'view') b ON a.user_id = b.user_id AND a.ts >= b.ts),
    followed AS (SELECT user_id, count(*) AS n FROM linked WHERE us <= 7200000000 GROUP BY 1)
    SELECT s.user_id AS entity_key, c.c_name AS name, n.n_name AS nation, s.last_ts, b.value AS speed,
           b.event_type AS speed_source, s.n_reports, coalesce(f.n, 0) AS n_followed
    FROM seen s JOIN best b USING (user_id) LEFT JOIN followed f USING (user_id)
    LEFT JOIN customer c ON c.c_custkey = s.user_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey"""


@query("entity_picture", PICTURE)
def entity_picture(spark, sf):
    return run_batch(events(spark, sf), named_places(spark, sf), PLAN)["fused"]


@query("entity_picture_stream", PICTURE)
def entity_picture_stream(spark, sf):
    """The same records from the events as a stream, taken in over two runs."""
    out, checkpoint, path = scratch(spark, "out"), scratch(spark, "ck"), feed(spark, sf)
    for _ in range(2):
        run_stream(event_stream(spark, path).withColumn("ts", F.col("ts").cast("timestamp_ntz")), PLAN, out, checkpoint)
    return stored_picture(spark, out, named_places(spark, sf), PLAN)["fused"]


@query("reconcile_stream", """
    SELECT stage, 4 AS n_batches, 0 AS n_missing, count(*) AS n_in, count(*) AS n_out, true AS balanced
    FROM events, (VALUES ('decode'), ('reports')) s(stage) GROUP BY 1""")
def stream_balance(spark, sf):
    """Lines decoded, and reports decoded, checked and parted, as streams over two runs each:
    what the micro-batches took in beside what is stored."""
    seen, lines, out = (scratch(spark, n) for n in ("seen", "lines", "out"))
    feed_path, checkpoints = feed(spark, sf), [scratch(spark, "ck"), scratch(spark, "ck")]
    with BatchCounts(spark, seen):
        for _ in range(2):
            raw = counted(broken(event_stream(spark, feed_path)), "decode")
            run_available(split_fields(raw, "raw", ";", LINE), deliver_to(lines), checkpoints[0])
            rows = event_stream(spark, feed_path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
            run_stream(counted(rows, "reports"), PLAN, out, checkpoints[1])
    good, bad = route_rejects(read_deliveries(spark, lines))
    sides = {n: read_deliveries(spark, f"{out}/{n}") for n in ("valid", "quarantine", "rejects")}
    found = reconcile_stream(read_counts(spark, seen), {"decode": {"good": good, "rejects": bad}, "reports": sides})
    return found.withColumns({c: F.col(c).cast("int") for c in ("n_batches", "n_missing")})


@query("run_batch_sides", """
    SELECT side, count(*) AS n_rows FROM (
      SELECT CASE WHEN value < 200.0 AND json_extract(props, '$.k') IS NOT NULL THEN 'valid' ELSE 'quarantine' END AS side FROM events)
    GROUP BY 1 UNION ALL SELECT 'linked', count(*) FROM events
    WHERE value < 200.0 AND json_extract(props, '$.k') IS NOT NULL AND event_type = 'click'""")
def sides(spark, sf):
    """How many rows each side output of the batch run holds."""
    parts = run_batch(events(spark, sf), named_places(spark, sf), PLAN)
    count = lambda name, df: df.groupBy(F.lit(name).alias("side")).agg(F.count(F.lit(1)).alias("n_rows"))
    valid = parts["fused"].groupBy(F.lit("valid").alias("side")).agg(F.sum("n_reports").alias("n_rows"))
    return (valid.unionAll(count("quarantine", parts["quarantine"])).unionAll(count("rejects", parts["rejects"]))
            .unionAll(count("linked", parts["linked"])))


def _resumed(spark, sf):
    """A run that ends after validation, and one that goes on from there: its raw input
    fails when it is read, and need not be."""
    path, raw, places = scratch(spark, "journal"), events(spark, sf), named_places(spark, sf)
    gone = raw.withColumn("event_id", F.raise_error(F.lit("read again")).cast("bigint"))
    run_batch_resumed(spark, raw, places, PLAN, path, raw_mark=sf, until="validate")
    return path, run_batch_resumed(spark, gone, places, PLAN, path, raw_mark=sf)


@query("run_batch_resumed", PICTURE)
def resumed(spark, sf):
    return _resumed(spark, sf)[1]["fused"]


@query("batch_journal", """
    WITH valid AS (SELECT * FROM events WHERE value < 200.0 AND json_extract(props, '$.k') IS NOT NULL)
    SELECT 'decode' AS stage, 1 AS n_runs, count(*) AS n_rows FROM events
    UNION ALL SELECT 'validate', 1, count(*) FROM events
    UNION ALL SELECT 'correlate', 1, count(*) FROM valid WHERE event_type = 'click'
    UNION ALL SELECT 'fuse', 1, count(DISTINCT user_id) FROM valid
    UNION ALL SELECT 'enrich', 2, count(DISTINCT user_id) FROM valid""")
def journal_of_runs(spark, sf):
    """What the journal tells of the two runs and a third one with other reference data, which
    computes the last stage only."""
    path, _ = _resumed(spark, sf)
    run_batch_resumed(spark, events(spark, sf), named_places(spark, sf).withColumn("nation", F.concat("nation", F.lit(" (old)"))), PLAN, path, raw_mark=sf)
    return Journal(spark, path).entries().groupBy("stage").agg(F.count(F.lit(1)).cast("int").alias("n_runs"), F.max("n_rows").alias("n_rows"))


@query("publish", f"SELECT CAST(entity_key AS VARCHAR) AS record_key, 'b1' AS batch_id, count(*) AS n FROM ({PICTURE}) GROUP BY 1")
def published(spark, sf):
    """Stored, published, and published again under the next id: the second batch
    is empty. Returns what the XML deliveries hold."""
    final, out = scratch(spark, "final"), scratch(spark, "out")
    store(entity_picture(spark, sf), final)
    for batch in ("b1", "b1", "b2"):
        publish(spark, final, out, batch)
    sent = spark.read.option("basePath", f"{out}/xml").parquet(f"{out}/xml/batch_id=*")
    keys = sent.select(F.regexp_extract("xml", "<entity_key>([0-9]+)</entity_key>", 1).alias("record_key"), "batch_id")
    return keys.groupBy("record_key", "batch_id").agg(F.count(F.lit(1)).alias("n"))


@query("publish_changed", f"""
    WITH picture AS ({PICTURE})
    SELECT entity_key, name, n_reports, 'b1' AS batch_id FROM picture
    UNION ALL SELECT entity_key, name, n_reports + 1, 'b2' FROM picture WHERE entity_key % 3 = 0
    UNION ALL SELECT entity_key, name, n_reports, 'b3' FROM picture WHERE entity_key % 3 = 0""")
def published_changes(spark, sf):
    """Published, then with a third of the records altered, then as at first: the later
    batches hold exactly what differs from the batch before. Read back from the XML files."""
    first, second, out = scratch(spark, "final"), scratch(spark, "final"), scratch(spark, "out")
    store(entity_picture(spark, sf), first)
    altered = F.when(F.col("entity_key") % 3 == 0, F.col("n_reports") + 1).otherwise(F.col("n_reports"))
    store(spark.read.parquet(first).withColumn("n_reports", altered), second)
    for path, batch in ((first, "b1"), (second, "b2"), (second, "b2"), (first, "b3")):
        publish(spark, path, out, batch)
    sent = read_deliveries(spark, f"{out}/documents", "xml", ENTITY, rowTag="entity", **XML_TIMES)
    return sent.select("entity_key", "name", "n_reports", "batch_id")


ODD_NAME = "replace(name, 'Customer', 'Cust' || chr({mark}) || 'omer')"


@query("publish_odd_texts", f"""
    SELECT entity_key, CASE WHEN entity_key % 11 = 0 THEN {ODD_NAME.format(mark=65533)} ELSE name END AS name, n_reports
    FROM ({PICTURE})""")
def published_odd_texts(spark, sf):
    """Every 11th name holds a control character that XML has no way to write: the rest of
    the batch goes out all the same, and these with the replacement character."""
    final, out = scratch(spark, "final"), scratch(spark, "out")
    odd = F.when(F.col("entity_key") % 11 == 0, F.expr(ODD_NAME.format(mark=1))).otherwise(F.col("name"))
    store(entity_picture(spark, sf).withColumn("name", odd), final)
    publish(spark, final, out, "b1")
    return read_deliveries(spark, f"{out}/documents", "xml", ENTITY, rowTag="entity", **XML_TIMES).select("entity_key", "name", "n_reports")


@query("publish_withdrawn", f"""
    WITH picture AS ({PICTURE})
    SELECT CAST(entity_key AS VARCHAR) AS record_key, 'sent' AS what, 'b1' AS batch_id FROM picture
    UNION ALL SELECT CAST(entity_key AS VARCHAR), 'withdrawn', 'b2' FROM picture WHERE entity_key % 3 = 1
    UNION ALL SELECT CAST(entity_key AS VARCHAR), 'sent', 'b2' FROM picture WHERE entity_key % 3 = 0
    UNION ALL SELECT CAST(entity_key AS VARCHAR), 'sent', 'b4' FROM picture WHERE entity_key % 3 <> 2""")
def published_withdrawn(spark, sf):
    """Published; then a third of the records are gone and a third altered; then nothing is
    new; then all is as at first. What is gone is withdrawn once, what comes back is sent."""
    first, second, out = scratch(spark, "final"), scratch(spark, "final"), scratch(spark, "out")
    store(entity_picture(spark, sf), first)
    altered = F.when(F.col("entity_key") % 3 == 0, F.col("n_reports") + 1).otherwise(F.col("n_reports"))
    store(spark.read.parquet(first).filter("entity_key % 3 <> 1").withColumn("n_reports", altered), second)
    for path, batch in ((first, "b1"), (second, "b2"), (second, "b2"), (second, "b3"), (first, "b4")):
        publish(spark, path, out, batch)
    sent = read_deliveries(spark, f"{out}/xml").select(F.col("entity_key").cast("string").alias("record_key"), F.lit("sent").alias("what"), "batch_id")
    gone = read_deliveries(spark, f"{out}/withdrawn").select("record_key", F.lit("withdrawn").alias("what"), "batch_id")
    return sent.unionByName(gone)
