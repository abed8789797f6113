"""Registry, table readers and the inputs derived from the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...functions.skew import HotKeys
from ...schemas import EVENTS
from ...session import remove, scratch
from ...sources.readers import read_source, stream_source

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return read_source(spark, f"{sf}/events.parquet", "parquet", EVENTS)


def as_obs(df: DataFrame) -> DataFrame:
    """events as position reports: entity = user, source = event type."""
    return df.select(
        F.col("event_id").alias("obs_id"), F.col("event_type").alias("source"),
        F.col("user_id").alias("entity_key"), "ts",
        (F.col("value") % 180 - 90).alias("lat"),
        ((F.col("event_id") * 37) % 360 - 180).cast("double").alias("lon"),
        F.col("value").alias("speed"))


def obs(spark: SparkSession, sf: str) -> DataFrame:
    return as_obs(events(spark, sf))


OBS = """(SELECT event_id AS obs_id, event_type AS source, user_id AS entity_key, ts,
          value % 180 - 90 AS lat, CAST((event_id * 37) % 360 - 180 AS DOUBLE) AS lon,
          value AS speed FROM events)"""

# DuckDB's least() passes over nulls, so the case without a position is told first
HAVERSINE = """CASE WHEN {a}.lat IS NOT NULL AND {a}.lon IS NOT NULL AND {b}.lat IS NOT NULL AND {b}.lon IS NOT NULL
    THEN 2 * 6371008.8 * asin(sqrt(least(1.0,
      sin((radians({b}.lat) - radians({a}.lat)) / 2) * sin((radians({b}.lat) - radians({a}.lat)) / 2)
    + cos(radians({a}.lat)) * cos(radians({b}.lat))
      * sin(radians({b}.lon - {a}.lon) / 2) * sin(radians({b}.lon - {a}.lon) / 2)))) END"""


def haversine_sql(a: str, b: str) -> str:
    return HAVERSINE.format(a=a, b=b)


FEED_FILES = 4
FILE_ROWS = 2_000_000  # a larger feed has more files, of so many rows
# Keys of ordinary size counted as hot, so that they are cut
FORCED = HotKeys(min_rows=30, max_keys=400)


def feed(spark: SparkSession, sf: str, copies: int = 1) -> str:
    """The whole events table as a feed: time ranges written one after another, so
    that file times follow event times. Returns its folder."""
    return feed_of(spark, events(spark, sf), "ts", copies)


def feed_of(spark: SparkSession, rows: DataFrame, ts: str, copies: int = 1) -> str:
    """Rows in files of about equal size, one after another in time."""
    path = scratch(spark, "feed")
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    files = max(FEED_FILES, -(-rows.count() // FILE_ROWS))
    cuts = rows.agg(F.percentile_approx(at, [i / files for i in range(1, files)])).first()[0]
    # sorted into ranges in one pass; each file is then written from its range alone
    held, number = scratch(spark, "ranges"), sum(((at >= c).cast("int") for c in cuts), F.lit(0))
    ranged = rows.filter(at.isNotNull()).withColumn("__file", number)
    ranged.repartition(4 * files, "__file").write.partitionBy("__file").parquet(held)
    ranged = spark.read.schema(ranged.schema).parquet(held)
    for _ in range(copies):
        for i in range(files):
            ranged.filter(F.col("__file") == i).drop("__file").coalesce(1).write.mode("append").parquet(path)
    remove(spark, held)
    return path


def event_stream(spark: SparkSession, path: str, files: int | None = 1) -> DataFrame:
    """The feed as a stream, with event time as an instant (watermarks need one)."""
    return stream_source(spark, path, "parquet", EVENTS, files).withColumn("ts", F.col("ts").cast("timestamp"))


def plain_times(df: DataFrame) -> DataFrame:
    """Instants back to the tables' timestamp type."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if f.dataType.typeName() == "timestamp" else F.col(f.name) for f in df.schema.fields])


# The checksum of rows of events, as the operators take it
EVENT_SUM = """CAST(sum(CAST('0x' || substr(sha256(concat_ws('|', length(event_id::VARCHAR) || ':' || event_id, length(epoch_us(ts)::VARCHAR) || ':' || epoch_us(ts),
        length(user_id::VARCHAR) || ':' || user_id, length(event_type) || ':' || event_type, length(value::VARCHAR) || ':' || value::VARCHAR,
        length(props) || ':' || props)), 1, 15) AS BIGINT)) % (CAST(1 AS HUGEINT) << 60) AS BIGINT)"""
