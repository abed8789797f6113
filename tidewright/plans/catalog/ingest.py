from pyspark.sql import functions as F

from ...operators.ingest import dedup, source_inventory
from ...schemas import EVENTS
from ...session import scratch
from ...sources.readers import envelope, read_source
from ...streaming.run import run_available
from .base import EVENT_SUM, event_stream, events, feed, plain_times, query, table

ALL_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


@query("read_source", ALL_EVENTS)
def read_parquet(spark, sf):
    return read_source(spark, f"{sf}/events.parquet", "parquet", EVENTS)


def _round_trip(spark, sf, fmt, **opts):
    path = scratch(spark, fmt)
    events(spark, sf).write.format(fmt).options(**opts).save(path)
    return read_source(spark, path, fmt, EVENTS, **opts)


TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


@query("read_source_json", ALL_EVENTS)
def read_json(spark, sf):
    return _round_trip(spark, sf, "json", **TIMES)


@query("read_source_csv", ALL_EVENTS)
def read_csv(spark, sf):
    return _round_trip(spark, sf, "csv", header="true", escape='"', **TIMES)


@query("read_source_orc", ALL_EVENTS)
def read_orc(spark, sf):
    return _round_trip(spark, sf, "orc")


@query("read_source_text", """
    SELECT event_id || '|' || user_id || '|' || event_type || '|' || props AS value, true AS has_file FROM events""")
def read_text(spark, sf):
    path = scratch(spark, "text")
    (events(spark, sf).select(F.concat_ws("|", "event_id", "user_id", "event_type", "props").alias("value"))
     .write.text(path))
    lines = read_source(spark, path, "text", with_file=True)
    return lines.select("value", F.col("file").isNotNull().alias("has_file"))


@query("stream_source", ALL_EVENTS)
def stream(spark, sf):
    out = scratch(spark, "out")
    run_available(event_stream(spark, feed(spark, sf)), out, scratch(spark, "ck"))
    return plain_times(spark.read.parquet(out))


@query("envelope", r"""
    SELECT sha256(concat_ws('|', length(event_type) || ':' || event_type, length(raw) || ':' || raw)) AS raw_id, event_type AS source, ts AS received_ts, raw
    FROM (SELECT *, concat_ws('|', event_id, user_id, event_type, props) AS raw FROM events)""")
def envelope_events(spark, sf):
    lines = events(spark, sf).withColumn("raw", F.concat_ws("|", "event_id", "user_id", "event_type", "props"))
    return envelope(lines, F.col("event_type"), "raw", "ts").drop("file")


@query("dedup", """
    SELECT doc_id, text, lang, source, n_chars FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def dedup_documents(spark, sf):
    return dedup(table(spark, sf, "documents"), ["text"], ["doc_id"])


@query("dedup_lineitem", """
    SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus) = 1""")
def dedup_lines(spark, sf):
    return dedup(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                 ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                  "l_tax", "l_returnflag", "l_linestatus"])


@query("dedup_stream", ALL_EVENTS)
def dedup_feed(spark, sf):
    out = scratch(spark, "out")
    twice = event_stream(spark, feed(spark, sf, copies=2), files=4)
    run_available(dedup(twice, ["event_id"], ts="ts", delay="60 days"), out, scratch(spark, "ck"))
    return plain_times(spark.read.parquet(out))


@query("source_inventory", """
    SELECT event_type AS source, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts,
           count(DISTINCT user_id) AS n_entities FROM events GROUP BY 1""")
def inventory(spark, sf):
    seen = events(spark, sf).withColumnRenamed("event_type", "source")
    return source_inventory(seen, ["source"], "ts", "user_id", with_checksum=False)


@query("source_inventory_checksum", f"""
    SELECT event_type AS source, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts,
           count(DISTINCT user_id) AS n_entities, {EVENT_SUM} AS checksum FROM events GROUP BY 1""")
def inventory_checksum(spark, sf):
    seen = events(spark, sf).withColumnRenamed("event_type", "source")
    return source_inventory(seen, ["source"], "ts", "user_id")
