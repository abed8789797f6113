"""Ingestion: first copies and what each source holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..sources.readers import content_id


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key. Spark limits each key to one row per task before
    the shuffle (WindowGroupLimit), so a key with very many copies stays cheap."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") == 1).drop("__n")


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = (),
          ts: str | None = None, delay: str | None = None) -> DataFrame:
    """Keeps the first copy by `order` (by all other columns, if not given). A stream keeps the first to arrive and forgets keys
    once the watermark on `ts` has passed them by `delay`."""
    if df.isStreaming:
        return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
    return first_rows(df, keys, order or [c for c in df.columns if c not in keys] or list(keys))


BITS = 60  # of each row's SHA-256: fifteen hex digits, so that any engine can add them up


def row_number(df: DataFrame) -> Column:
    """A number for a row: the leading 60 bits of the SHA-256 of its columns as texts, times
    as microseconds."""
    times = (T.TimestampType, T.TimestampNTZType)
    texts = [F.unix_micros(F.col(f"`{f.name}`").cast("timestamp")) if isinstance(f.dataType, times) else F.col(f"`{f.name}`")
             for f in df.schema.fields]
    return F.conv(F.substring(content_id(texts), 1, BITS // 4), 16, 10).cast("decimal(38,0)")


def checksum(total: Column) -> Column:
    """Order-free: equal row multisets give equal sums of row numbers, and a repeated row
    does not cancel itself out."""
    return F.pmod(total.cast("decimal(38,0)"), F.lit(2 ** BITS).cast("decimal(38,0)")).cast("bigint")


def source_inventory(df: DataFrame, by: Sequence[str], ts: str, entity: str,
                     with_checksum: bool = True) -> DataFrame:
    """Rows, time span, number of entities and checksum per source.

    Two levels, so that distinct entities are counted after a map-side combine on
    (source, entity) and a source holding most rows is not one task's work.
    """
    inner = [F.count(F.lit(1)).alias("n"), F.min(ts).alias("a"), F.max(ts).alias("b")]
    if with_checksum:
        inner.append(F.sum(row_number(df)).alias("h"))
    outer = [F.sum("n").alias("n_rows"), F.min("a").alias("first_ts"), F.max("b").alias("last_ts"),
             F.count(entity).alias("n_entities")]
    if with_checksum:
        outer.append(checksum(F.sum("h")).alias("checksum"))
    return df.groupBy(*by, entity).agg(*inner).groupBy(*by).agg(*outer)
