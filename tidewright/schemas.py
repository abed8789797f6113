"""Fixed table layouts. Nothing is inferred from data in a run."""

from pyspark.sql import types as T

RAW = T.StructType([
    T.StructField("raw_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("received_ts", T.TimestampType()),
    T.StructField("raw", T.StringType()),
])

OBS = T.StructType([
    T.StructField("obs_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("entity_key", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("course", T.DoubleType()),
    T.StructField("status", T.IntegerType()),
])

STATIC = T.StructType([
    T.StructField("entity_key", T.LongType()),
    T.StructField("valid_from", T.TimestampType()),
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.IntegerType()),
    T.StructField("length", T.DoubleType()),
    T.StructField("width", T.DoubleType()),
    T.StructField("call_sign", T.StringType()),
    T.StructField("destination", T.StringType()),
])

LINKS = T.StructType([
    T.StructField("left_id", T.LongType()),
    T.StructField("right_id", T.LongType()),
    T.StructField("dt_seconds", T.DoubleType()),
    T.StructField("dist_m", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
])

POINT = T.StructType([
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
])

ZONES = T.StructType([
    T.StructField("zone_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("ring", T.ArrayType(POINT)),
    T.StructField("min_x", T.DoubleType()),
    T.StructField("max_x", T.DoubleType()),
    T.StructField("min_y", T.DoubleType()),
    T.StructField("max_y", T.DoubleType()),
])

MANIFEST = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("part", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("checksum", T.LongType()),
    T.StructField("created_ts", T.TimestampType()),
])

LEDGER = T.StructType([
    T.StructField("record_key", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("delivered_ts", T.TimestampType()),
    T.StructField("digest", T.StringType()),
])

# The driver-style `events` feed, as read from parquet or as JSON lines.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
