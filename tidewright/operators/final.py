"""Final data: keeping the stored table right, summaries, differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from ..session import cut_lineage, exists, remove
from ..sources.sinks import write_final
from .ingest import first_rows


def upsert_final(current: DataFrame, changes: DataFrame, keys: Sequence[str], version: str,
                 tie: Sequence[str] = ()) -> DataFrame:
    """Current rows with newer versions from `changes` put in, new keys added."""
    both = current.withColumn("__new", F.lit(0)).unionByName(changes.withColumn("__new", F.lit(1)))
    order = [F.desc(version), F.desc("__new"), *[F.asc(t) for t in tie]]
    return first_rows(both, keys, order).drop("__new")


def merge_into(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], version: str,
               partition_cols: Sequence[str], staging: str, tie: Sequence[str] = ()) -> None:
    """Upserts into a stored table, reading and rewriting only the partitions that
    `changes` touches (the null partition included); their values, not their rows,
    come to the driver. Partition columns must be among the keys, so that a record
    never moves.

    The new partitions are staged in full before the table's are replaced, and the
    stage is removed last. A run that dies while staging left the table as it was;
    one that dies while replacing is finished from its stage by the next run, never
    computed again from a half-replaced table. `staging` belongs to this table alone.
    """
    if not set(partition_cols) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    schema = changes.schema  # stored partition values are texts: "007" must not come back as 7

    def replace() -> None:
        write_final(spark.read.schema(schema).parquet(staging), path, partition_cols)
        remove(spark, staging)

    if exists(spark, f"{staging}/_SUCCESS"):
        replace()
    touched = changes.select(*partition_cols).distinct().collect()
    if not touched:
        return
    here = reduce(or_, [reduce(and_, [F.col(c).eqNullSafe(F.lit(row[c]).cast(schema[c].dataType)) for c in partition_cols])
                        for row in touched])
    current = spark.read.schema(schema).parquet(path).filter(here)
    merged = upsert_final(current.select(*changes.columns), changes, keys, version, tie)
    merged.write.mode("overwrite").parquet(staging)
    replace()


def period_summary(df: DataFrame, ts: str, size_seconds: int, slide_seconds: int | None = None,
                   dims: Sequence[str] = (), value: str | None = None, watermark: str | None = None) -> DataFrame:
    """Count, sum, least and greatest value per tumbling or sliding period.

    In batch, rows are first combined into panes of one slide each and only the
    panes are copied to the periods they belong to, so sliding costs no more
    shuffle than tumbling. On a stream Spark's window does the same job under the
    watermark.
    """
    slide = slide_seconds or size_seconds
    measures = [F.count(F.lit(1)).alias("n_rows")]
    merged = [F.sum("n_rows").alias("n_rows")]
    if value:
        measures += [F.sum(value).alias("total"), F.min(value).alias("lowest"), F.max(value).alias("highest")]
        merged += [F.sum("total").alias("total"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest")]
    if df.isStreaming:
        w = F.window(ts, f"{size_seconds} seconds", f"{slide} seconds")
        out = df.withWatermark(ts, watermark).groupBy(*dims, w.alias("__w")).agg(*measures)
        return out.select(*dims, F.col("__w.start").alias("period_start"), *[c for c in out.columns
                          if c not in (*dims, "__w")])
    if size_seconds % slide:
        raise ValueError("the period must be a whole number of slides")
    panes = (df.groupBy(*dims, F.window(ts, f"{slide} seconds").alias("__w")).agg(*measures)
               .withColumn("period_start", F.col("__w.start")).drop("__w"))
    if slide == size_seconds:
        return panes.select(*dims, "period_start", *[c for c in panes.columns if c not in (*dims, "period_start")])
    shifts = F.sequence(F.lit(0), F.lit(size_seconds // slide - 1))
    start = F.timestamp_micros(F.unix_micros(F.col("period_start").cast("timestamp"))
                               - F.col("__k") * F.lit(slide * 1_000_000).cast("bigint")).cast(panes.schema["period_start"].dataType)
    spread = panes.withColumn("__k", F.explode(shifts)).withColumn("period_start", start).drop("__k")
    return spread.groupBy(*dims, "period_start").agg(*merged)


def period_sketch(df: DataFrame, ts: str, size_seconds: int, dims: Sequence[str], entity: str, value: str,
                  fractions: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Approximate number of entities and value percentiles per period: mergeable
    sketches of fixed size, for periods too large to sort."""
    w = F.window(ts, f"{size_seconds} seconds")
    return (df.groupBy(*dims, w.alias("__w"))
              .agg(F.approx_count_distinct(entity).alias("n_entities"),
                   F.percentile_approx(value, list(fractions)).alias("percentiles"))
              .select(*dims, F.col("__w.start").alias("period_start"), "n_entities", "percentiles"))


def sketch_panes(df: DataFrame, ts: str, pane_seconds: int, dims: Sequence[str], entity: str, value: str,
                 precision: int = 14, k: int = 400) -> DataFrame:
    """(dims…, pane_start, n_rows, entities, values): per pane of time a HyperLogLog sketch of
    the entities (2 to the `precision` registers) and a KLL sketch of the values, as binary
    columns of bounded size. To be stored: panes can be merged to any longer period, also
    several of one time, as a stream or late rows bring them."""
    start = F.window(ts, f"{pane_seconds} seconds")["start"].alias("pane_start")
    return df.groupBy(*dims, start).agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(entity, precision).alias("entities"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("values"))


def merge_sketches(panes: DataFrame, pane_seconds: int, size_seconds: int, slide_seconds: int | None = None,
                   dims: Sequence[str] = ()) -> DataFrame:
    """Stored panes merged to tumbling or sliding periods: (dims…, period_start, n_rows,
    entities, values). Both lengths are whole numbers of panes; `dims` may be fewer than
    the panes have. Rows are never read again, and a pane is copied once per period it is in.
    """
    slide = slide_seconds or size_seconds
    if size_seconds % slide or slide % pane_seconds:
        raise ValueError("a period must be a whole number of slides, a slide of panes")
    at = F.unix_micros(F.col("pane_start").cast("timestamp"))
    width = F.lit(slide * 1_000_000).cast("bigint")
    first = at - F.pmod(at, width)
    start = F.timestamp_micros(first - F.col("__k") * width).cast(panes.schema["pane_start"].dataType)
    spread = panes.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(size_seconds // slide - 1)))).withColumn("period_start", start)
    return spread.groupBy(*dims, "period_start").agg(
        F.sum("n_rows").alias("n_rows"), F.hll_union_agg("entities").alias("entities"),
        F.kll_merge_agg_double("values").alias("values"))


def read_sketches(merged: DataFrame, fractions: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """What the sketches tell: n_entities and the values at the given fractions."""
    at = F.array(*[F.kll_sketch_get_quantile_double("values", F.lit(float(f))) for f in fractions])
    return merged.withColumns({"n_entities": F.hll_sketch_estimate("entities"), "quantiles": at}).drop("entities", "values")


SALTS = 256


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """The first n rows of each group (or of all) by a total order, with `rank`.

    Spark cuts each group to n rows per task before the shuffle for n up to
    spark.sql.optimizer.windowGroupLimitThreshold; beyond it a group is first cut
    to n rows in each of SALTS parts, so a group holding most rows is not one task.
    """
    if not group:  # at most n rows are numbered
        return df.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        part = Window.partitionBy(*group, "__salt").orderBy(*order)
        df = salted.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= n).drop("__salt", "rank")
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with change = added, removed or altered between two tables of unique
    keys. Rows travel as a SHA-256 of their other columns, not whole."""
    digest = _digests(old, new, keys)
    return _differences(digest(old, "__old"), digest(new, "__new"), keys)


def changes_blocks(old: DataFrame, new: DataFrame, keys: Sequence[str], blocks: int = 16_384) -> DataFrame:
    """The rows of `changes`, for tables that are mostly alike: both are first summed by
    blocks of keys (rows, and the sum of their content numbers, combined map-side), and only
    rows of blocks whose sums differ are shuffled and joined. One altered row costs its
    block, a `blocks`-th of the table."""
    digest = _digests(old, new, keys)
    block = F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int").alias("__block")

    def sums(df: DataFrame, name: str) -> DataFrame:
        number = F.conv(F.substring(F.sha2(F.concat(F.to_json(F.struct(*keys)).cast("binary"), name), 256), 1, 15), 16, 10)
        return df.groupBy(block).agg(F.count(F.lit(1)).alias(f"n{name}"), F.sum(number.cast("decimal(38,0)")).alias(f"t{name}"))

    a, b = digest(old, "__old"), digest(new, "__new")
    both = sums(a, "__old").join(sums(b, "__new"), "__block", "full_outer")
    apart = cut_lineage(both.filter(~(F.col("n__old").eqNullSafe(F.col("n__new")) & F.col("t__old").eqNullSafe(F.col("t__new"))))
                        .select("__block"))

    def within(df: DataFrame) -> DataFrame:  # at most `blocks` numbers are sent
        return df.withColumn("__block", block).join(F.broadcast(apart), "__block", "left_semi").drop("__block")

    return _differences(within(a), within(b), keys)


def _digests(old: DataFrame, new: DataFrame, keys: Sequence[str]):
    rest = sorted(c for c in old.columns if c not in keys)
    if set(new.columns) != set(old.columns):
        raise ValueError("both tables must have the same columns")

    def digest(df: DataFrame, name: str) -> DataFrame:
        body = F.to_json(F.struct(*rest), {  # times to the microsecond, as they are stored
            "ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}) if rest else F.lit("")
        return df.select(*keys, F.unhex(F.sha2(body, 256)).alias(name))

    return digest


def _differences(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    b = b.withColumnsRenamed({k: f"__{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    joined = a.join(b, cond, "full_outer")
    kind = (F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed")
            .when(~F.col("__old").eqNullSafe(F.col("__new")), "altered"))
    key = [F.when(F.col("__old").isNull(), F.col(f"__{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    return joined.select(*key, kind.alias("change")).filter(F.col("change").isNotNull())


def row_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Whole rows only in one of the tables, repeats counted, for tables without a key."""
    cols = old.columns
    signed = (old.withColumn("__d", F.lit(-1)).unionByName(new.select(*cols).withColumn("__d", F.lit(1)))
                 .groupBy(*cols).agg(F.sum("__d").alias("n_added")))
    return signed.filter(F.col("n_added") != 0)
