import os

from pyspark.sql import functions as F, types as T

from ...operators.xml import check_xml, to_xml_column, validate_xml_files, xml_documents, xml_documents_by_bytes
from ...schemas import EVENTS
from ...session import scratch
from ...sources.readers import read_source
from ...sources.sinks import XML_TIMES, stream_xml, write_xml
from ..batch import CONTRACTS
from .base import event_stream, events, feed, plain_times, query
from .ingest import ALL_EVENTS
from .validate import FORCED

ELEMENT = """'<report><id>' || event_id || '</id>' || CASE WHEN event_type <> 'error' THEN '<kind>' || event_type || '</kind>' ELSE '' END
    || '<user>' || user_id || '</user></report>'"""


def report_columns(spark, sf):
    return events(spark, sf).select(F.col("event_id").alias("id"), F.nullif("event_type", F.lit("error")).alias("kind"),
                                    F.col("user_id").alias("user"), "ts", "event_type")


@query("to_xml_column", f"SELECT event_id AS id, {ELEMENT} AS xml FROM events")
def elements(spark, sf):
    return to_xml_column(report_columns(spark, sf), ["id", "kind", "user"], "report").select("id", "xml")


@query("write_xml", ALL_EVENTS)
def files(spark, sf):
    path = scratch(spark, "xml")
    write_xml(events(spark, sf), path, "events", "event")
    return read_source(spark, path, "xml", EVENTS, rowTag="event", **XML_TIMES)


@query("stream_xml", ALL_EVENTS)
def files_stream(spark, sf):
    path = scratch(spark, "xml")
    query_ = stream_xml(plain_times(event_stream(spark, feed(spark, sf))), path, "events", "event", scratch(spark, "ck"))
    query_.awaitTermination()
    return read_source(spark, path, "xml", EVENTS, rowTag="event", **XML_TIMES)


DOCUMENTS = f"""
    SELECT event_type, part, count(*) AS n_rows, '<reports>' || string_agg(x, '' ORDER BY ts, event_id) || '</reports>' AS document
    FROM (SELECT *, {ELEMENT} AS x, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 500 AS part FROM events)
    GROUP BY 1, 2"""


@query("xml_documents", DOCUMENTS)
def documents(spark, sf):
    return xml_documents(report_columns(spark, sf), ["event_type"], ["ts", "id"], ["id", "kind", "user"], "reports", "report", 500)


@query("xml_documents_hot", DOCUMENTS)
def documents_hot(spark, sf):
    return xml_documents(report_columns(spark, sf), ["event_type"], ["ts", "id"], ["id", "kind", "user"], "reports", "report",
                         500, hot=FORCED)


BY_BYTES = f"""
    WITH x AS (SELECT event_type, ts, event_id, {ELEMENT} AS x FROM events),
    s AS (SELECT *, sum(strlen(x)) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS upto, (SELECT max(strlen(x)) FROM x) AS largest FROM x)
    SELECT event_type, CAST((upto - 1) // (5000 - 19 - largest) AS BIGINT) AS part, count(*) AS n_rows,
           '<reports>' || string_agg(x, '' ORDER BY ts, event_id) || '</reports>' AS document,
           CAST(sum(strlen(x)) + 19 AS BIGINT) AS n_bytes, sum(strlen(x)) + 19 <= 5000 AS fits
    FROM s GROUP BY 1, 2"""


@query("xml_documents_by_bytes", BY_BYTES)
def documents_by_bytes(spark, sf):
    found = xml_documents_by_bytes(report_columns(spark, sf), ["event_type"], ["ts", "id"], ["id", "kind", "user"], "reports", "report", 5_000)
    return found.withColumn("fits", F.col("n_bytes") <= 5_000)


@query("xml_documents_by_bytes_hot", BY_BYTES)
def documents_by_bytes_hot(spark, sf):
    found = xml_documents_by_bytes(report_columns(spark, sf), ["event_type"], ["ts", "id"], ["id", "kind", "user"], "reports", "report",
                                   5_000, hot=FORCED)
    return found.withColumn("fits", F.col("n_bytes") <= 5_000)


REPORT = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])
REPORT_XSD = os.path.join(CONTRACTS, "report.xsd")


def suspect_elements(spark, sf):
    """Events as report elements; every 5th lacks its value, every 7th has text for it."""
    value = F.when(F.col("event_id") % 7 == 0, F.lit("much")).otherwise(F.col("value").cast("string"))
    v = F.when(F.col("event_id") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("<v>"), value, F.lit("</v>")))
    return events(spark, sf).select("event_id", F.concat(F.lit("<report><id>"), "event_id", F.lit("</id>"), v, F.lit("</report>")).alias("xml"))


@query("validate_xml", """
    SELECT event_id, CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 THEN value END AS v,
           event_id % 5 <> 0 AND event_id % 7 <> 0 AS keeps_contract FROM events""")
def contract(spark, sf):
    checked = check_xml(suspect_elements(spark, sf), "xml", REPORT, REPORT_XSD, "report")
    return checked.select("event_id", F.col("doc.v").alias("v"), F.col("error").isNull().alias("keeps_contract"))


@query("validate_xml_files", """
    SELECT event_id AS id, CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 THEN value END AS v,
           event_id % 5 <> 0 AND event_id % 7 <> 0 AS keeps_contract FROM events""")
def contract_files(spark, sf):
    path = scratch(spark, "xml")
    v = F.when(F.col("event_id") % 7 == 0, F.lit("much")).otherwise(F.col("value").cast("string"))
    v = F.when(F.col("event_id") % 5 != 0, v)
    write_xml(events(spark, sf).select(F.col("event_id").alias("id"), v.alias("v")), path, "reports", "report")
    good, bad = validate_xml_files(spark, path, REPORT, REPORT_XSD, "report")
    refused = bad.select(F.regexp_extract("xml", r"<id>(\d+)</id>", 1).cast("bigint").alias("id"),
                         F.lit(None).cast("double").alias("v"), F.lit(False).alias("keeps_contract"))
    return good.withColumn("keeps_contract", F.lit(True)).unionByName(refused)
