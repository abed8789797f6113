"""Order-dependent columns per key (neighbour row, running value, row number)
that do not put a hot key's rows into one task.

Ordinary keys use one window over the key. A hot key is cut along its own time
axis into chunks of about equal size; windows run per (key, chunk), and what a
chunk needs from its neighbours is one small row per chunk, carried over and
joined back by broadcast. The cut points are computed once and kept as literals,
so all branches of a plan cut at the same places.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .skew import DEFAULT_HOT, Hot, HotKeys, heavy_keys

CHUNK = "__chunk"
BLOCK = 64
SAMPLE = 1_000  # rows looked at per chunk when choosing cut points


def slices_of(heavy: list, per_chunk: int) -> int:
    return sum(math.ceil(r["n"] / per_chunk) for r in heavy)


def _axis(df: DataFrame, ts: str) -> tuple[Column, T.DataType]:
    """The order column as a number that never falls where the column rises, so cuts
    along it keep the column's own order: fractions as doubles, texts by their first
    seven bytes (Spark orders texts by bytes)."""
    kind = df.schema[ts].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(ts).cast("timestamp")), T.LongType()
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return F.col(ts).cast("double"), T.DoubleType()
    if isinstance(kind, (T.StringType, T.BinaryType)):
        lead = F.rpad(F.substring(F.hex(F.col(ts).cast("binary")), 1, 14), 14, "0")
        return F.conv(lead, 16, 10).cast("bigint"), T.LongType()
    return F.col(ts).cast("bigint"), T.LongType()


class OrderedCut:
    """Cut points of the hot keys of one dataset; empty when there are none. Made
    once, they can be passed as `hot` to every operator on the same keys."""

    hot: HotKeys = DEFAULT_HOT

    @classmethod
    def of(cls, df: DataFrame, keys: Sequence[str], ts: str, hot: Hot) -> OrderedCut:
        """`hot` as operators take it: when a key counts as hot, or cut points made
        earlier for these keys, or None where no key can be hot."""
        return hot if isinstance(hot, OrderedCut) and hot.keys == list(keys) else cls(df, keys, ts, hot)

    def __init__(self, df: DataFrame, keys: Sequence[str], ts: str, hot: Hot = DEFAULT_HOT):
        self.keys = list(keys)
        self.cuts = None
        if hot is None:
            return
        if isinstance(hot, OrderedCut):
            hot = hot.hot
        self.hot = hot
        heavy = heavy_keys(df, self.keys, hot)
        if not heavy:
            return
        spark = df.sparkSession
        total = sum(r["n"] for r in heavy)
        per_chunk = max(hot.min_rows, math.ceil(total / hot.max_keys))
        most = max(r["n"] for r in heavy)
        slices = max(2, math.ceil(most / per_chunk))
        fields = [T.StructField(f"__k{i}", df.schema[k].dataType) for i, k in enumerate(self.keys)]
        named = spark.createDataFrame(
            [(*[r[k] for k in self.keys], max(1, slices * per_chunk // r["n"])) for r in heavy],
            T.StructType([*fields, T.StructField("__step", T.LongType())]))
        # where to cut may be estimated from a sample: the cuts decide balance, not results
        share = SAMPLE * slices_of(heavy, per_chunk) / total
        axis, number = _axis(df, ts)
        times = df.select(*self.keys, axis.alias("__t"))
        marked = self._with(times.sample(share, 7) if share < 1 else times, named, "inner")
        points = (marked.groupBy(*[f.name for f in fields], "__step")
                  .agg(F.percentile_approx("__t", [i / slices for i in range(1, slices)],
                                           max(1_000, 4 * slices)).alias("p"))
                  .select(*[f.name for f in fields],
                          F.array_distinct(F.filter("p", lambda x, i: (i + 1) % F.col("__step") == 0))
                          .alias("p"))
                  .collect())
        rows = []
        for r in points:
            p = sorted(r["p"] or [])
            blocks = [p[i:i + BLOCK] for i in range(0, len(p), BLOCK)]
            rows.append((*[r[f.name] for f in fields], blocks, len(p)))
        self.cuts = spark.createDataFrame(rows, T.StructType([
            *fields,
            T.StructField("__blocks", T.ArrayType(T.ArrayType(number))),
            T.StructField("__last", T.IntegerType())]))

    def _with(self, df: DataFrame, small: DataFrame, how: str) -> DataFrame:
        cond = F.lit(True)
        for i, k in enumerate(self.keys):
            cond = cond & df[k].eqNullSafe(small[f"__k{i}"])
        return df.join(F.broadcast(small), cond, how)

    @property
    def by(self) -> list[str]:
        return self.keys + ([CHUNK] if self.cuts is not None else [])

    def assign(self, df: DataFrame, ts: str) -> DataFrame:
        """Adds the chunk number: 0, 1, … for hot keys, -1 for the others."""
        if self.cuts is None:
            return df
        t, _ = _axis(df, ts)
        below = F.size(F.filter("__blocks", lambda b: b[0] < t))
        within = F.size(F.filter(F.get("__blocks", below - 1), lambda x: x < t))
        chunk = (F.when(F.col("__blocks").isNull(), -1).when(below <= 0, 0)
                  .otherwise((below - 1) * BLOCK + within))
        return (self._with(df, self.cuts, "left").withColumn(CHUNK, chunk.cast("int"))
                .select(*df.columns, CHUNK))

    def carry(self, summary: DataFrame, value: str, forward: bool = True) -> DataFrame:
        """From one `value` per (key, chunk) to the nearest non-null one in an
        earlier (forward) or later chunk. One row per chunk of a hot key."""
        w = Window.partitionBy(*self.by[:-1]).orderBy(F.col(CHUNK).asc() if forward else F.col(CHUNK).desc())
        return self._grid(summary, value).withColumn(
            value, F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, -1)))

    def carry_sum(self, summary: DataFrame, value: str) -> DataFrame:
        """Sum of `value` over the earlier chunks."""
        w = Window.partitionBy(*self.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        return self._grid(summary, value).withColumn(
            value, F.coalesce(F.sum(value).over(w), F.lit(0).cast("bigint")))

    def _grid(self, summary: DataFrame, value: str) -> DataFrame:
        grid = self.cuts.select(
            *[F.col(f"__k{i}").alias(k) for i, k in enumerate(self.keys)],
            F.explode(F.sequence(F.lit(0), F.col("__last"))).alias(CHUNK))
        s = summary.select(*[F.col(k).alias(f"__s{i}") for i, k in enumerate(self.keys)],
                           F.col(CHUNK).alias("__sc"), value)
        cond = F.col(CHUNK) == F.col("__sc")
        for i, k in enumerate(self.keys):
            cond = cond & grid[k].eqNullSafe(s[f"__s{i}"])
        return grid.join(s, cond, "left").select(*self.keys, CHUNK, value)

    def join_carry(self, df: DataFrame, carry: DataFrame, value: str) -> DataFrame:
        small = carry.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)],
                             F.col(CHUNK).alias("__cc"), value)
        cond = df[CHUNK] == small["__cc"]
        for i, k in enumerate(self.keys):
            cond = cond & df[k].eqNullSafe(small[f"__k{i}"])
        return df.join(F.broadcast(small), cond, "left").select(*df.columns, value)


def neighbour_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                  out: str, forward: bool = True, hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Adds struct `out` of `cols` from the row before (forward) or after, null at
    the end of a key. `order` must be total within a key; its first column is the
    time axis."""
    cut = OrderedCut.of(df, keys, order[0], hot)
    value = F.struct(*cols)
    w = Window.partitionBy(*cut.by).orderBy(*order)
    step = F.lag(value) if forward else F.lead(value)
    if cut.cuts is None:
        return df.withColumn(out, step.over(w))
    parts = cut.assign(df, order[0])
    edge = F.max_by if forward else F.min_by
    summary = (parts.filter(F.col(CHUNK) >= 0).groupBy(*cut.by)
               .agg(edge(value, F.struct(*order)).alias("__edge")))
    local = parts.withColumn(out, step.over(w))
    done = cut.join_carry(local, cut.carry(summary, "__edge", forward), "__edge")
    return done.withColumn(out, F.coalesce(out, "__edge")).drop("__edge", CHUNK)


def running_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                 out: str, edge_order: Sequence[str], hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Adds `out`: the latest non-null `value` up to and including the row.

    `edge_order` names the columns that order the non-null values themselves."""
    cut = OrderedCut.of(df, keys, order[0], hot)
    w = (Window.partitionBy(*cut.by).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if cut.cuts is None:
        return df.withColumn(out, F.last(value, True).over(w))
    parts = cut.assign(df, order[0])
    summary = (parts.filter((F.col(CHUNK) >= 0) & F.col(value).isNotNull()).groupBy(*cut.by)
               .agg(F.max_by(value, F.struct(*edge_order)).alias("__edge")))
    local = parts.withColumn(out, F.last(value, True).over(w))
    done = cut.join_carry(local, cut.carry(summary, "__edge"), "__edge")
    return done.withColumn(out, F.coalesce(out, "__edge")).drop("__edge", CHUNK)


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
                hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Adds `out`: 1, 2, … within each key in the given total order."""
    cut = OrderedCut.of(df, keys, order[0], hot)
    number = F.row_number().over(Window.partitionBy(*cut.by).orderBy(*order)).cast("bigint")
    if cut.cuts is None:
        return df.withColumn(out, number)
    parts = cut.assign(df, order[0])
    summary = (parts.filter(F.col(CHUNK) >= 0).groupBy(*cut.by)
               .agg(F.count(F.lit(1)).alias("__before")))
    done = cut.join_carry(parts.withColumn(out, number), cut.carry_sum(summary, "__before"), "__before")
    return done.withColumn(out, F.col(out) + F.coalesce("__before", F.lit(0))).drop("__before", CHUNK)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Adds `out`: the sum of a whole number over the rows of the key up to and including
    this one, in the given total order."""
    cut = OrderedCut.of(df, keys, order[0], hot)
    w = Window.partitionBy(*cut.by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum(F.col(value).cast("bigint")).over(w)
    if cut.cuts is None:
        return df.withColumn(out, total)
    parts = cut.assign(df, order[0])
    summary = (parts.filter(F.col(CHUNK) >= 0).groupBy(*cut.by)
               .agg(F.sum(F.col(value).cast("bigint")).alias("__before")))
    done = cut.join_carry(parts.withColumn(out, total), cut.carry_sum(summary, "__before"), "__before")
    return done.withColumn(out, F.col(out) + F.coalesce("__before", F.lit(0))).drop("__before", CHUNK)
