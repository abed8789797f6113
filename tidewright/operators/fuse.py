"""Fusion: many reports of an entity to one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geo
from ..functions.ordered import neighbour_row
from ..functions.skew import DEFAULT_HOT, Hot
from ..functions.timecols import floor_div, micros


def rank_of(source: str, priority: Sequence[str]) -> Column:
    """0 for the most trusted source; sources not listed come last."""
    rank = F.lit(len(priority))
    for i, name in reversed(list(enumerate(priority))):
        rank = F.when(F.col(source) == name, F.lit(i)).otherwise(rank)
    return rank


def fuse_attributes(df: DataFrame, key: str, attrs: Sequence[str], priority: Sequence[str],
                    source: str = "source", ts: str = "ts", tie: Sequence[str] = ("obs_id",),
                    also: Sequence[Column] = ()) -> DataFrame:
    """One row per entity: for each attribute its best non-null value and the
    source it came from, by source priority, then recency, then id. A plain
    aggregate with map-side combine, so a hot entity is no problem; `also` takes
    further aggregates to compute in the same pass."""
    order = F.struct((-rank_of(source, priority)).alias("p"), F.col(ts).alias("t"), *tie)
    picks = []
    for a in attrs:
        best = F.max_by(F.struct(F.col(a).alias("v"), F.col(source).alias("s")),
                        F.when(F.col(a).isNotNull(), order))
        picks.append(best.alias(f"__{a}"))
    fused = df.groupBy(key).agg(*picks, *also)
    rest = [c for c in fused.columns if c != key and c not in {f"__{a}" for a in attrs}]
    return fused.select(key, *[c for a in attrs for c in (F.col(f"__{a}.v").alias(a),
                                                          F.col(f"__{a}.s").alias(f"{a}_source"))], *rest)


def fuse_measurements(df: DataFrame, key: str, ts: str, step: str, means: Mapping[str, float],
                      circular: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Weighted means per entity and time bucket.

    `means` names each value's unit (0.01 = two decimals); sums are taken over
    whole units, and over sines and cosines in steps of 1e-9, so the result does
    not depend on the order rows arrive in. `circular` values are degrees. Rows
    with a null value do not count for that value, nor do values that are no number, infinite
    or beyond 64 bits of units; `weight` is a whole number.
    """
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    sums = [F.count(F.lit(1)).alias("n_rows")]
    for c, unit in means.items():
        units = F.round(F.col(c) / unit).try_cast("bigint")
        sums.append(F.sum(w * units).alias(f"__s_{c}"))
        sums.append(F.sum(F.when(units.isNotNull(), w)).alias(f"__w_{c}"))
    for c in circular:
        for name, fn in (("y", F.sin), ("x", F.cos)):
            sums.append(F.sum(w * F.round(fn(F.radians(c)) * 1e9).try_cast("bigint")).alias(f"__{name}_{c}"))
    out = df.groupBy(key, F.window(ts, step).alias("__w")).agg(*sums)
    cols = [F.col(key), F.col("__w.start").alias("bucket_start"), F.col("n_rows")]
    cols += [(F.try_divide(F.col(f"__s_{c}").cast("double"), F.col(f"__w_{c}").cast("double")) * u).alias(c)
             for c, u in means.items()]
    cols += [F.when((F.col(f"__y_{c}") != 0) | (F.col(f"__x_{c}") != 0),
                    geo.wrap_course(F.degrees(F.atan2(F.col(f"__y_{c}"), F.col(f"__x_{c}"))))).alias(c)
             for c in circular]
    return out.select(*cols)


GRID_ROWS = 1 << 14


def resample(df: DataFrame, key: str, ts: str, step_seconds: int, cols: Sequence[str],
             method: str = "last", max_gap: float | None = None, tie: Sequence[str] = (),
             hot: Hot = DEFAULT_HOT) -> DataFrame:
    """A regular time grid per entity, from its first to its last fix.

    Each fix fills the grid points from itself up to the next fix (method "last":
    its value; "linear": on the line to the next fix), so no join is needed. Past
    `max_gap` seconds after a fix the grid is left empty. A gap is laid out in stretches of
    GRID_ROWS points and these in points, so the arrays of one row stay short: ten years
    by seconds are 19,000 stretches.
    """
    step = step_seconds * 1_000_000
    stretch = step * GRID_ROWS
    rows = neighbour_row(df, [key], [ts, *tie], [ts, *cols], "__next", forward=False, hot=hot)
    rows = rows.withColumns({"__t": micros(ts), "__u": micros(F.col(f"__next.{ts}"))})
    first = -floor_div(-F.col("__t"), step) * step
    stop = F.coalesce(F.col("__u") - 1, F.col("__t"))
    if max_gap is not None:
        stop = F.least(stop, F.col("__t") + round(max_gap * 1e6))
    grid = rows.withColumns({"__a": first, "__b": stop}).filter(F.col("__a") <= F.col("__b"))
    grid = grid.withColumn("__a", F.explode(F.sequence("__a", "__b", F.lit(stretch).cast("bigint"))))
    end = F.least(F.col("__b"), F.col("__a") + F.lit(stretch - step))
    grid = grid.withColumn("__g", F.explode(F.sequence("__a", end, F.lit(step).cast("bigint"))))
    share = (F.col("__g") - F.col("__t")) / (F.col("__u") - F.col("__t"))

    def value(c: str) -> Column:
        if method == "last":
            return F.col(c)
        after = F.col(f"__next.{c}")
        return F.when(F.col("__g") == F.col("__t"), F.col(c)).otherwise(F.col(c) + share * (after - F.col(c)))

    at = F.timestamp_micros("__g").cast(df.schema[ts].dataType)
    return grid.select(key, at.alias("grid_ts"), *[value(c).alias(c) for c in cols])


def conflicts(df: DataFrame, key: str, attrs: Sequence[str], source: str = "source") -> DataFrame:
    """Attributes on which an entity's reports disagree: how many values, from how
    many sources, and the lowest and highest as text.

    Values are made distinct with a map-side combine before they are counted, and
    only counts and extremes are kept, so nothing grows with the number of values.
    """
    long = df.select(key, F.col(source).alias("__s"), F.explode(F.array(*[
        F.struct(F.lit(a).alias("attr"), F.col(a).cast("string").alias("value")) for a in attrs])).alias("__a"))
    values = (long.select(key, "__s", "__a.attr", "__a.value").filter(F.col("value").isNotNull())
                  .groupBy(key, "attr", "value", "__s").agg(F.count(F.lit(1)).alias("n"))
                  .groupBy(key, "attr", "value").agg(F.sum("n").alias("n"),
                                                     F.min("__s").alias("s1"), F.max("__s").alias("s2")))
    return (values.groupBy(key, "attr")
            .agg(F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("n_rows"),
                 F.min("value").alias("lowest"), F.max("value").alias("highest"),
                 F.min("s1").alias("first_source"), F.max("s2").alias("last_source"))
            .filter(F.col("n_values") > 1))


def latest_state(df: DataFrame, key: str, ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """The newest row of each entity. On a stream this is an aggregate whose state
    is one row per entity: write it in update mode."""
    rest = [c for c in df.columns if c != key]
    newest = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(ts, *tie)).alias("__row"))
    return newest.select(key, *[F.col(f"__row.{c}").alias(c) for c in rest])
