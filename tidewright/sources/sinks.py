"""Output: the final table, XML files and deliveries. Every write replaces a
well-defined target, so repeating it changes nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def write_final(df: DataFrame, path: str, partition_cols: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replaces the partitions present in `df` and leaves the others alone.

    The rebalance hint groups rows by partition value before the write while
    letting adaptive execution split a value that holds very many rows and merge
    the small ones, so neither one giant task nor a flood of tiny files results.
    """
    out = df.hint("rebalance", *partition_cols) if partition_cols else df
    writer = out.write.mode("overwrite").format(fmt)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def write_split(df: DataFrame, path: str, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Stores `df` once, parted by a condition (null counts as false), and returns
    the two stored sides: (where it holds, the rest). For stages with two outputs,
    so that what leads up to them runs once."""
    flagged = df.withColumn("__holds", F.coalesce(condition, F.lit(False)))
    flagged.write.mode("overwrite").partitionBy("__holds").option("partitionOverwriteMode", "static").parquet(path)
    stored = df.sparkSession.read.schema(flagged.schema).parquet(path)
    return stored.filter("__holds").drop("__holds"), stored.filter("NOT __holds").drop("__holds")


# Full precision: the XML writer otherwise cuts times to milliseconds.
XML_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# Fixed pattern: characters that XML 1.0 cannot hold, however they are written
NOT_XML = r"[^\x09\x0A\x0D\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"


def xml_safe(value: Column, kind: T.DataType) -> Column:
    """The value with every character that XML cannot hold, in texts at any depth, put as
    U+FFFD; other values as they are."""
    if isinstance(kind, T.StringType):
        return F.regexp_replace(value, NOT_XML, "\uFFFD")
    if isinstance(kind, T.ArrayType) and _has_text(kind):
        return F.transform(value, lambda x: xml_safe(x, kind.elementType))
    if isinstance(kind, T.StructType) and _has_text(kind):
        fields = [xml_safe(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.MapType) and _has_text(kind):
        return F.transform_values(value, lambda _, x: xml_safe(x, kind.valueType))
    return value


def _has_text(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_text(kind.elementType)
    if isinstance(kind, T.MapType):
        return _has_text(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(_has_text(f.dataType) for f in kind.fields)
    return isinstance(kind, T.StringType)


def xml_ready(df: DataFrame) -> DataFrame:
    """Rows that the XML writer takes without an error: one bad character in one text would
    end the whole job."""
    return df.select(*[xml_safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def write_xml(df: DataFrame, path: str, root_tag: str, row_tag: str) -> None:
    """XML files; characters that XML cannot hold become U+FFFD."""
    (xml_ready(df).write.mode("overwrite").format("xml")
       .options(rootTag=root_tag, rowTag=row_tag, **XML_TIMES).save(path))


def stream_xml(df: DataFrame, path: str, root_tag: str, row_tag: str, checkpoint: str):
    """Started query that appends XML files; run it with the available data."""
    return (xml_ready(df).writeStream.format("xml").outputMode("append")
            .options(rootTag=root_tag, rowTag=row_tag, checkpointLocation=checkpoint, **XML_TIMES)
            .trigger(availableNow=True).start(path))


def deliver(df: DataFrame, path: str, batch_id: str | int, fmt: str = "parquet", **opts) -> None:
    """Writes one delivery to its own folder. Calling it again with the same
    batch id replaces that folder, so at-least-once calls deliver once.

    `fmt` and `opts` go to the Spark writer as they are; formats that are not
    files need their connector on the classpath and bring their own guarantees.
    """
    df.write.mode("overwrite").format(fmt).options(**opts).save(f"{path}/batch_id={batch_id}")


def read_deliveries(spark, path: str, fmt: str = "parquet", schema=None, **opts) -> DataFrame:
    """All deliveries, with their batch ids as they were given: "001" stays "001"."""
    if schema is None:
        schema = spark.read.format(fmt).options(**opts, basePath=path).load(f"{path}/batch_id=*").drop("batch_id").schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    fields = [f for f in schema.fields if f.name != "batch_id"]
    full = T.StructType([*fields, T.StructField("batch_id", T.StringType())])
    return spark.read.format(fmt).options(**opts, basePath=path).schema(full).load(f"{path}/batch_id=*")
