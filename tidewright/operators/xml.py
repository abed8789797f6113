"""XML: row elements, whole documents, and checks against an XSD contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.ordered import row_numbers, running_sum
from ..functions.skew import DEFAULT_HOT, Hot
from ..sources.sinks import XML_TIMES, xml_safe

CORRUPT = "_corrupt"


def to_xml_column(df: DataFrame, cols: Sequence[str], row_tag: str, out: str = "xml") -> DataFrame:
    """Adds the row as one XML element, children in the given order; a null is an
    absent element. One line per element, without padding. Characters that XML cannot
    hold become U+FFFD."""
    safe = [xml_safe(F.col(f"`{c}`"), df.schema[c].dataType).alias(c) for c in cols]
    text = F.to_xml(F.struct(*safe), {"rowTag": row_tag, **XML_TIMES})
    return df.withColumn(out, F.regexp_replace(text, r">\s+<", "><"))


def xml_documents(df: DataFrame, group: Sequence[str], order: Sequence[str], cols: Sequence[str],
                  root_tag: str, row_tag: str, max_rows: int = 10_000,
                  hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Documents per delivery unit: (group…, part, n_rows, document).

    A unit of more than max_rows rows becomes several numbered documents, so a
    document always fits one row whatever the size of the unit; rows keep their
    order across parts. Rows are numbered without gathering a large unit in one
    task.
    """
    numbered = row_numbers(df, group, order, "__n", hot)
    numbered = to_xml_column(numbered, cols, row_tag, "__x")
    part = F.floor((F.col("__n") - 1) / max_rows).cast("bigint").alias("part")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", "__x"))), lambda r: r["__x"]), "")
    return (numbered.groupBy(*group, part)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.concat(F.lit(f"<{root_tag}>"), body, F.lit(f"</{root_tag}>")).alias("document")))


def xml_documents_by_bytes(df: DataFrame, group: Sequence[str], order: Sequence[str], cols: Sequence[str],
                           root_tag: str, row_tag: str, max_bytes: int = 8 << 20, hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Documents per delivery unit, none of more than `max_bytes` UTF-8 bytes:
    (group…, part, n_rows, n_bytes, document). `order` must be total within a unit.

    Elements are cut where their running size, summed along the order without gathering a
    large unit in one task, passes the next multiple of what the bound leaves beside the
    largest element; part numbers rise along the order and may leave gaps. A single element
    beyond the bound raises an error, which names its size.
    """
    sized = to_xml_column(df, cols, row_tag, "__x").withColumn("__b", F.octet_length("__x"))
    largest = sized.agg(F.max("__b")).first()[0] or 0
    room = max_bytes - 2 * len(root_tag.encode()) - len("<></>") - largest
    if room < 0:
        raise ValueError(f"an element of {largest} bytes does not fit a document of {max_bytes}")
    summed = running_sum(sized, group, order, "__b", "__sum", hot)
    part = F.floor((F.col("__sum") - 1) / F.lit(max(1, room))).cast("bigint").alias("part")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__sum", "__x"))), lambda r: r["__x"]), "")
    document = F.concat(F.lit(f"<{root_tag}>"), body, F.lit(f"</{root_tag}>")).alias("document")
    return (summed.groupBy(*group, part).agg(F.count(F.lit(1)).alias("n_rows"), document)
            .withColumn("n_bytes", F.octet_length("document").cast("bigint")))


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def ship_contract(spark: SparkSession, xsd: str) -> str:
    """Makes the XSD available on every executor; returns the name to refer to it by."""
    spark.sparkContext.addFile(xsd)
    return xsd.rsplit("/", 1)[-1]


def check_xml(df: DataFrame, col: str, schema: T.StructType, xsd: str, row_tag: str,
              out: str = "doc") -> DataFrame:
    """Adds the parsed struct `out` and `error`, set where the element in `col`
    breaks the contract; both from one pass of the XSD validator."""
    name = ship_contract(df.sparkSession, xsd)
    options = {"rowTag": row_tag, "rowValidationXSDPath": name, "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": CORRUPT, **XML_TIMES}
    # explode keeps the validator from being copied into every filter that uses its result
    parsed = df.withColumn("__doc", F.explode(F.array(F.from_xml(F.col(col), _with_corrupt(schema), options))))
    bad = F.col(col).isNull() | F.col("__doc").isNull() | F.col(f"__doc.{CORRUPT}").isNotNull()
    fields = F.struct(*[F.col(f"__doc.{f.name}") for f in schema.fields])
    return parsed.withColumns({out: F.when(~bad, fields),
                               "error": F.when(bad, F.lit("breaks the contract"))}).drop("__doc")


def validate_xml(df: DataFrame, col: str, schema: T.StructType, xsd: str, row_tag: str,
                 out: str = "doc") -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows of a column of XML elements. Valid rows gain the
    parsed struct, invalid ones keep their text as it was.

    Reading both sides validates twice; `check_xml` with `write_split` does not.
    """
    checked = check_xml(df, col, schema, xsd, row_tag, out)
    return (checked.filter(F.col("error").isNull()).drop("error"),
            checked.filter(F.col("error").isNotNull()).drop(out, "error"))


def validate_xml_files(spark: SparkSession, path: str, schema: T.StructType, xsd: str,
                       row_tag: str) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) elements of XML files: parsed rows, and the texts that
    break the contract."""
    name = ship_contract(spark, xsd)
    rows = (spark.read.format("xml").schema(_with_corrupt(schema))
            .options(rowTag=row_tag, rowValidationXSDPath=name, mode="PERMISSIVE",
                     columnNameOfCorruptRecord=CORRUPT, **XML_TIMES).load(path))
    good = rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    # Spark refuses queries that need the corrupt text alone, so a parsed column is named too
    some = F.col(schema.names[0])
    bad = rows.filter(F.col(CORRUPT).isNotNull() & (some.isNull() | some.isNotNull()))
    return good, bad.select(F.col(CORRUPT).alias("xml"))
