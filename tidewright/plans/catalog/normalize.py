from pyspark.sql import functions as F, types as T

from ...operators.normalize import (conform, map_codes, normalize_text, normalize_time, null_sentinels,
                                    scale_units, union_sources, wrap_angles)
from .base import OBS, events, obs, query, table

SMALL_OBS = T.StructType([
    T.StructField("obs_id", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("entity_key", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("speed", T.DoubleType()), T.StructField("status", T.IntegerType())])


@query("conform", """
    SELECT CAST(event_id AS VARCHAR) AS obs_id, event_type AS source, user_id AS entity_key, ts, value AS speed,
           CAST(NULL AS INTEGER) AS status FROM events""")
def conform_events(spark, sf):
    return conform(events(spark, sf), SMALL_OBS, {"obs_id": "event_id", "source": "event_type",
                                                  "entity_key": "user_id", "speed": "value"})


@query("null_sentinels", """
    SELECT event_id, CASE WHEN event_type NOT IN ('error') THEN event_type END AS event_type,
           CASE WHEN user_id NOT IN (0, 1) THEN user_id END AS user_id FROM events""")
def sentinels(spark, sf):
    return null_sentinels(events(spark, sf).select("event_id", "event_type", "user_id"),
                          {"event_type": ["error"], "user_id": [0, 1]})


@query("scale_units", "SELECT event_id, value * 0.514444 + 0.0 AS value FROM events")
def scale(spark, sf):
    return scale_units(events(spark, sf).select("event_id", "value"), {"value": (0.514444, 0.0)})


@query("normalize_text", """
    SELECT p_partkey, upper(p_name) AS p_name, upper(trim(p_brand)) AS p_brand FROM part""")
def text(spark, sf):
    messy = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit("  "), F.regexp_replace("p_name", " ", "   "), F.lit("@@@")).alias("p_name"), "p_brand")
    return normalize_text(messy, ["p_name", "p_brand"])


@query("normalize_text_documents", r"""
    SELECT doc_id, nullif(upper(replace(trim(regexp_replace(translate(text, '@', ' '), '[ \t\n\x0B\f\r]+', ' ', 'g')), 'ß', 'ss')), '') AS text
    FROM documents""")
def text_documents(spark, sf):
    return normalize_text(table(spark, sf, "documents").select("doc_id", "text"), ["text"])


@query("normalize_time", "SELECT event_id, date_trunc('second', ts) AS ts FROM events")
def times(spark, sf):
    """Times written in three forms, two of them as local time two hours ahead."""
    at = F.date_trunc("second", F.col("ts").cast("timestamp"))
    ahead = at + F.expr("interval 2 hours")
    written = (F.when(F.col("event_id") % 3 == 0, F.date_format(ahead, "yyyy-MM-dd HH:mm:ss"))
               .when(F.col("event_id") % 3 == 1, F.date_format(ahead, "dd/MM/yyyy HH:mm:ss"))
               .otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX")))
    texts = events(spark, sf).select("event_id", written.alias("ts"))
    out = normalize_time(texts, "ts", ["yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssXXX"], "+02:00")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# Meaning of the event codes that are known.
CODES = [("click", "C"), ("view", "V"), ("purchase", "P")]


@query("map_codes", """
    SELECT e.event_id, e.event_type, coalesce(c.value, 'other') AS value
    FROM events e LEFT JOIN (VALUES ('click', 'C'), ('view', 'V'), ('purchase', 'P')) c(code, value)
      ON e.event_type = c.code""")
def codes(spark, sf):
    known = spark.createDataFrame(CODES, "event_type string, value string")
    return map_codes(events(spark, sf).select("event_id", "event_type"), known, "event_type", "other")


@query("union_sources", """
    SELECT o_orderkey AS id, o_orderdate AS ts, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS kind FROM orders
    UNION ALL BY NAME SELECT event_id AS id, ts, event_type AS kind FROM events""")
def union(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"),
                                               F.col("o_totalprice").alias("amount"))
    seen = events(spark, sf).select(F.col("event_id").alias("id"), "ts", F.col("event_type").alias("kind"))
    return union_sources(orders, seen)


@query("wrap_angles", f"""
    SELECT obs_id, ((((lon * 3 + 180) % 360) + 360) % 360) - 180 AS lon,
           (((speed * 7 - 400) % 360) + 360) % 360 AS course FROM {OBS}""")
def angles(spark, sf):
    wide = obs(spark, sf).select("obs_id", (F.col("lon") * 3).alias("lon"), (F.col("speed") * 7 - 400).alias("course"))
    return wrap_angles(wide, "lon", "course")
