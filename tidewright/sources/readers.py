"""Input: batch and streaming readers with declared schemas, and the envelope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

NULL_MARK = "\\N"


def read_source(spark: SparkSession, path: str | list[str], fmt: str,
                schema: T.StructType | str | None = None, with_file: bool = False, **opts) -> DataFrame:
    """Any file format Spark reads, under the given schema (`text` has its own).

    `with_file` adds the origin of each row as `file`.
    """
    reader = spark.read.format(fmt).options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df.withColumn("file", F.col("_metadata.file_path")) if with_file else df


def stream_source(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str | None = None,
                  max_files: int | None = None, with_file: bool = False, **opts) -> DataFrame:
    """The same rows, arriving file by file."""
    reader = spark.readStream.format(fmt).options(**opts)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df.withColumn("file", F.col("_metadata.file_path")) if with_file else df


def content_id(cols: Sequence[str | Column]) -> Column:
    """SHA-256 over the columns as text, each led by its length in characters, so no two
    rows read alike; null and empty text differ."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(NULL_MARK)) for t in texts]
    return F.sha2(F.concat_ws("|", *parts), 256)


def envelope(df: DataFrame, source: str | Column, raw_col: str, received: str | Column | None = None,
             keep: Sequence[str] = ()) -> DataFrame:
    """Adds origin and a record id that depends on source and content only, so a
    record read twice, or from a renamed file, keeps its id."""
    src = F.lit(source) if isinstance(source, str) else source
    file = F.col("file") if "file" in df.columns else F.lit(None).cast("string")
    when = (F.current_timestamp() if received is None
            else F.col(received) if isinstance(received, str) else received)
    return df.select(content_id([src, raw_col]).alias("raw_id"), src.alias("source"), file.alias("file"),
                     when.alias("received_ts"), F.col(raw_col).alias("raw"), *keep)
