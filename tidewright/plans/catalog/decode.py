from pyspark.sql import Window, functions as F, types as T

from ...functions import sixbit
from ...operators.decode import (check_integrity, decode_bits, parse_document, reassemble_parts,
                                 route_rejects, split_fields)
from ..layouts import EVENT_PACK
from ...session import cut_lineage, scratch
from ...sources.readers import stream_source
from ...sources.sinks import read_deliveries
from ...streaming.run import deliver_to, python_tasks, run_available
from ...streaming.state import reassemble_stream
from .base import FORCED, events, feed_of, query, table


def broken_lines(spark, sf):
    return broken(events(spark, sf))


def broken(rows):
    """Events as delimited lines; every 7th has a value that is no number."""
    value = F.when(F.col("event_id") % 7 == 0, F.lit("n/k")).otherwise(F.col("value").cast("string"))
    return rows.select(F.concat_ws(";", "event_id", "user_id", "event_type", value).alias("raw"))


LINE = [("event_id", "bigint"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double")]


@query("split_fields", """
    SELECT event_id, user_id, event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS value,
           CASE WHEN event_id % 7 = 0 THEN 'bad value' END AS error FROM events""")
def split(spark, sf):
    return split_fields(broken_lines(spark, sf), "raw", ";", LINE).drop("raw")


PROPS = T.StructType([T.StructField("k", T.LongType())])


@query("parse_document_json", """
    SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
           event_id % 11 = 0 AS is_bad FROM events""")
def parse_json(spark, sf):
    text = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    docs = events(spark, sf).select("event_id", text.alias("props"))
    return parse_document(docs, "props", PROPS, "json").select(
        "event_id", F.col("doc.k").alias("k"), F.col("error").isNotNull().alias("is_bad"))


REPORT = T.StructType([T.StructField("id", T.LongType()), T.StructField("kind", T.StringType()),
                       T.StructField("v", T.DoubleType())])


@query("parse_document_xml", "SELECT event_id AS id, event_type AS kind, value AS v FROM events")
def parse_xml(spark, sf):
    text = F.concat(F.lit("<report><id>"), "event_id", F.lit("</id><kind>"), "event_type",
                    F.lit("</kind><v>"), F.col("value").cast("string"), F.lit("</v></report>"))
    docs = events(spark, sf).select(text.alias("xml"))
    return parse_document(docs, "xml", REPORT, "xml", rowTag="report").select("doc.*")


@query("parse_document_csv", "SELECT event_id AS id, event_type AS kind, value AS v FROM events")
def parse_csv(spark, sf):
    text = F.concat_ws(",", "event_id", "event_type", F.col("value").cast("string"))
    docs = events(spark, sf).select(text.alias("line"))
    return parse_document(docs, "line", REPORT, "csv").select("doc.*")


def sentences(spark, sf):
    """Events as checksummed sentences; every 7th carries a wrong checksum."""
    body = F.concat_ws(",", F.lit("AIVDM"), "event_id", "user_id", "event_type")
    x = sixbit.xor_of(body)
    x = F.when(F.col("event_id") % 7 == 0, x.bitwiseXOR(F.lit(1))).otherwise(x)
    return events(spark, sf).select("event_id", F.concat(F.lit("!"), body, F.lit("*"), F.lpad(F.hex(x), 2, "0")).alias("raw"))


@query("check_integrity", """
    SELECT event_id, '!' || body || '*' || upper(lpad(to_hex(CASE WHEN event_id % 7 = 0 THEN xor(x, 1) ELSE x END), 2, '0')) AS raw,
           CASE WHEN event_id % 7 = 0 THEN 'wrong checksum' END AS error
    FROM (SELECT event_id, body,
                 list_reduce(list_transform(string_split(body, ''), lambda c: ascii(c)), lambda a, b: xor(a, b)) AS x
          FROM (SELECT event_id, concat_ws(',', 'AIVDM', event_id, user_id, event_type) AS body FROM events))""")
def integrity(spark, sf):
    return check_integrity(sentences(spark, sf), "raw")


def turns_as_parts(spark, sf):
    """Conversations as multi-part messages: one turn a part, a second apart. Every
    5th claims one part more than it has; every 3rd sends its first part twice."""
    turns = table(spark, sf, "conversations")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    parts = turns.join(sizes, "conv_id").select(
        "conv_id", (F.col("turn") + 1).alias("part_no"),
        (F.col("n") + F.when(F.col("conv_id") % 5 == 0, 1).otherwise(0)).alias("n_parts"),
        F.timestamp_seconds(1_700_000_000 + F.col("turn")).alias("received_ts"), F.col("text").alias("payload"))
    again = parts.filter((F.col("conv_id") % 3 == 0) & (F.col("part_no") == 1)).withColumn(
        "received_ts", F.col("received_ts") + F.expr("interval 1 second"))
    return parts.unionByName(again)


PARTS = """
    SELECT conv_id, CAST(count(*) + CASE WHEN conv_id % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_parts,
           CAST(count(*) AS INTEGER) AS n_present,
           CASE WHEN conv_id % 5 <> 0 THEN string_agg(text, '' ORDER BY turn) END AS payload,
           CASE WHEN conv_id % 5 = 0 THEN 'incomplete' END AS error
    FROM conversations GROUP BY conv_id"""


@query("reassemble_parts", PARTS)
def reassemble(spark, sf):
    whole = reassemble_parts(turns_as_parts(spark, sf), ["conv_id"], "received_ts", "part_no", "n_parts", "payload", 60)
    return whole.select("conv_id", "n_parts", "n_present", "payload", "error")


@query("reassemble_reused_numbers", """
    SELECT user_id, CAST(2 AS INTEGER) AS n_parts, CAST(2 AS INTEGER) AS n_present, event_id || 'a' || event_id || 'b' AS payload,
           CAST(NULL AS VARCHAR) AS error FROM events""")
def reassemble_reused(spark, sf):
    """Each event as a message of two parts, all of a user under one sequence number and
    well within the gap: where a part number comes again, the next message begins."""
    rows = events(spark, sf).withColumn("n", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")))
    part = lambda k, tail: rows.select(
        "user_id", F.lit(k).alias("part_no"), F.lit(2).alias("n_parts"),
        F.timestamp_seconds(1_700_000_000 + F.col("n") * 10 + k).alias("received_ts"),
        F.concat(F.col("event_id").cast("string"), F.lit(tail)).alias("payload"))
    whole = reassemble_parts(part(1, "a").unionByName(part(2, "b")), ["user_id"], "received_ts", "part_no", "n_parts", "payload", 60)
    return whole.select("user_id", "n_parts", "n_present", "payload", "error")


def busy_parts(spark, sf):
    """Each event as a message of two parts, all of a user under one sequence number, ten
    seconds apart: two messages in a row begin with the same first part, every 14th lost
    its second part, every 14th has its parts the wrong way round, and every 5th has its
    first part twice. A lone message of nobody comes an hour later."""
    rows = events(spark, sf).withColumn("n", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")))
    turned = (F.col("n") % 14 == 5).cast("int")
    base = F.lit(1_700_000_000).cast("bigint") + F.col("n") * 10

    def part(k, seconds, payload, rows=rows):
        return rows.select("user_id", F.lit(k).alias("part_no"), F.lit(2).alias("n_parts"),
                           F.timestamp_millis(((base + seconds) * 1000).cast("bigint")).alias("received_ts"), payload.alias("payload"))

    first = F.concat(F.lit("P"), F.floor(F.col("n") / 2).cast("string"))
    second = F.concat(F.lit("Q"), F.col("event_id").cast("string"))
    hour = spark.range(1).select(F.lit(-1).cast("bigint").alias("user_id"), F.lit(1).alias("part_no"), F.lit(1).alias("n_parts"),
                                 F.timestamp_seconds(F.lit(1_700_100_000)).alias("received_ts"), F.lit("end").alias("payload"))
    return (part(1, turned + 1, first).unionByName(part(2, F.lit(2) - turned, second, rows.filter("n % 14 <> 3")))
            .unionByName(part(1, turned + 1.5, first, rows.filter("n % 5 = 0"))).unionByName(hour))


BUSY = """
    SELECT user_id, CAST(2 AS INTEGER) AS n_parts, CAST(CASE WHEN n % 14 = 3 THEN 1 ELSE 2 END AS INTEGER) AS n_present,
           make_timestamp((1700000000 + n * 10 + 1) * 1000000) AS started,
           make_timestamp((1700000000 + n * 10 + CASE WHEN n % 14 = 3 THEN 1 ELSE 2 END) * 1000000) AS ended,
           CASE WHEN n % 14 <> 3 THEN 'P' || (n // 2) || 'Q' || event_id END AS payload,
           CASE WHEN n % 14 = 3 THEN 'incomplete' END AS error
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
    UNION ALL SELECT -1, 1, 1, make_timestamp(1700100000000000), make_timestamp(1700100000000000), 'end', NULL"""


def told(whole):
    return whole.select("user_id", "n_parts", "n_present", F.col("started").cast("timestamp_ntz").alias("started"),
                        F.col("ended").cast("timestamp_ntz").alias("ended"), "payload", "error")


@query("reassemble_busy", BUSY)
def reassemble_busy(spark, sf):
    return told(reassemble_parts(busy_parts(spark, sf), ["user_id"], "received_ts", "part_no", "n_parts", "payload", 60))


@query("reassemble_busy_hot", BUSY)
def reassemble_busy_hot(spark, sf):
    """The same with the busiest numbers cut along time."""
    parts = cut_lineage(busy_parts(spark, sf))
    return told(reassemble_parts(parts, ["user_id"], "received_ts", "part_no", "n_parts", "payload", 60, hot=FORCED))


@query("reassemble_stream", BUSY)
def reassemble_as_stream(spark, sf):
    """The same parts as a stream, taken in over two runs of one checkpoint."""
    parts = cut_lineage(busy_parts(spark, sf))
    path, out, checkpoint = feed_of(spark, parts, "received_ts"), scratch(spark, "out"), scratch(spark, "ck")
    for _ in range(2):
        rows = stream_source(spark, path, "parquet", parts.schema, 1)
        whole = reassemble_stream(rows, ["user_id"], "received_ts", "part_no", "n_parts", "payload", 60, "30 seconds")
        run_available(whole, deliver_to(out), checkpoint, state_tasks=python_tasks(spark))
    return told(read_deliveries(spark, out))


def packed(spark, sf):
    rows = events(spark, sf).withColumn("value_cents", F.round(F.col("value") * 100).cast("bigint"))
    values = {"msg_type": F.lit(1), "repeat": F.lit(0), "user_id": F.col("user_id"),
              "value_cents": F.col("value_cents"), "event_id": F.col("event_id"), "pad": F.lit(0)}
    return rows.select("event_id", sixbit.encode(EVENT_PACK, values, 16).alias("payload"))


@query("encode_bits", """
    SELECT event_id, array_to_string(list_transform(range(16), lambda i:
             chr(CAST(CASE WHEN ((packed >> (90 - 6 * i)) & 63) >= 40 THEN ((packed >> (90 - 6 * i)) & 63) + 56
                           ELSE ((packed >> (90 - 6 * i)) & 63) + 48 END AS INTEGER))), '') AS payload
    FROM (SELECT event_id, (CAST(1 AS HUGEINT) << 90) | (CAST(user_id AS HUGEINT) << 58)
                 | (CAST(round(value * 100) AS HUGEINT) << 38) | (CAST(event_id AS HUGEINT) << 6) AS packed FROM events)""")
def encode(spark, sf):
    return packed(spark, sf)


@query("decode_bits", """
    SELECT CAST(1 AS BIGINT) AS msg_type, CAST(0 AS BIGINT) AS repeat, user_id,
           CAST(round(value * 100) AS BIGINT) AS value_cents, event_id, CAST(0 AS BIGINT) AS pad,
           CAST(NULL AS VARCHAR) AS error FROM events""")
def decode(spark, sf):
    return decode_bits(packed(spark, sf).drop("event_id"), "payload", EVENT_PACK).drop("payload")


@query("route_rejects", """
    SELECT CASE WHEN event_id % 7 = 0 THEN 'rejects' ELSE 'good' END AS side, count(*) AS n_rows,
           count(DISTINCT event_id) AS n_ids FROM events GROUP BY 1""")
def rejects(spark, sf):
    good, bad = route_rejects(split_fields(broken_lines(spark, sf), "raw", ";", LINE))
    rows = good.select("event_id", F.lit("good").alias("side")).unionByName(
        bad.select("event_id", F.lit("rejects").alias("side")))
    return rows.groupBy("side").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_id").alias("n_ids"))
