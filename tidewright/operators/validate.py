"""Validation: rules, quarantine, keys, motion, and counts that must balance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.geo import haversine_m
from ..functions.ordered import neighbour_row
from ..functions.skew import DEFAULT_HOT, Hot, fits_broadcast, unique_lookup
from ..functions.timecols import seconds_between
from ..session import cut_lineage


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    severity: str = "error"


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds `violations`, the broken rules in rule order. A predicate that is null
    counts as broken."""
    broken = [F.when(~F.coalesce(F.expr(r.predicate), F.lit(False)), F.lit(r.name)) for r in rules]
    return df.withColumn("violations", F.array_compact(F.array(*broken)) if broken
                         else F.array().cast("array<string>"))


def split_quarantine(df: DataFrame, rules: Sequence[Rule],
                     severities: Sequence[str] = ("error",)) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine): rows that break a rule of a listed severity are kept aside."""
    held = is_held(rules, severities)
    return df.filter(~held), df.filter(held)


def is_held(rules: Sequence[Rule], severities: Sequence[str] = ("error",)) -> Column:
    """Whether a row of `apply_rules` breaks a rule of a listed severity."""
    names = [r.name for r in rules if r.severity in severities]
    return F.arrays_overlap("violations", F.array(*[F.lit(n) for n in names])) if names else F.lit(False)


def check_unique(df: DataFrame, keys: Sequence[str], out: str = "is_repeated",
                 hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Flags rows whose key occurs more than once. Keys are counted with a
    map-side combine; the repeated ones are stored, which also tells how many they
    are, and joined back."""
    repeated = cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1))
    marked = unique_lookup(df, repeated, keys, hot=hot, null_safe=True)
    return marked.withColumn(out, F.col("__n").isNotNull()).drop("__n")


def check_reference(df: DataFrame, ref: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows whose key the reference does not know (null keys included)."""
    known = ref.select(*on)
    return df.join(F.broadcast(known) if fits_broadcast(known) else known, list(on), "left_anti")


def check_motion(df: DataFrame, key: str, ts: str, max_speed: float, lat: str = "lat", lon: str = "lon",
                 tie: Sequence[str] = (), hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Adds distance, time and implied speed (m/s) from the previous fix, and
    `too_fast`. Two places at one instant are too fast as well. Motion is measured
    from the last row that has a position; the first of them, and rows without one,
    have no distance, time or speed and are not too fast."""
    order = [ts, *tie]
    placed = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    prev = neighbour_row(df.filter(placed), [key], order, [ts, lat, lon], "__prev", hot=hot)
    prev = prev.unionByName(df.filter(~placed), allowMissingColumns=True)
    return moved(prev, F.col(f"__prev.{ts}"), F.col(f"__prev.{lat}"), F.col(f"__prev.{lon}"), ts, lat, lon, max_speed).drop("__prev")


def moved(df: DataFrame, prev_ts: Column, prev_lat: Column, prev_lon: Column, ts: str, lat: str, lon: str,
          max_speed: float) -> DataFrame:
    """Distance, time and implied speed (m/s) from a previous fix given as columns, and `too_fast`."""
    df = df.withColumns({"prev_dist_m": haversine_m(prev_lat, prev_lon, F.col(lat), F.col(lon)),
                         "prev_seconds": seconds_between(prev_ts, F.col(ts))})
    jumped = (F.col("prev_seconds") == 0) & (F.col("prev_dist_m") > 0)
    return (df.withColumn("speed_mps", F.try_divide("prev_dist_m", "prev_seconds"))
            .withColumn("too_fast", F.coalesce((F.col("speed_mps") > max_speed) | jumped, F.lit(False))))


def quality_report(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Rows per broken rule and dimension with all totals; rule is null for rows
    without violations, `level` (grouping id) tells totals from such nulls.

    Counted once per (dims, rule) before the cube multiplies anything.
    """
    base = (df.select(*dims, F.explode_outer("violations").alias("rule"))
              .groupBy(*dims, "rule").agg(F.count(F.lit(1)).alias("n")))
    return base.cube(*dims, "rule").agg(F.sum("n").alias("n_rows"),
                                        F.grouping_id().cast("bigint").alias("level"))


def reconcile(stages: Mapping[str, tuple[DataFrame, Mapping[str, DataFrame]]]) -> DataFrame:
    """Per stage: rows in, rows out over all its outputs, and whether they agree."""
    def counted(name: str, source: DataFrame, outs: Mapping[str, DataFrame]) -> DataFrame:
        sides = [source.select(F.lit(1).alias("i"), F.lit(0).alias("o"))]
        sides += [d.select(F.lit(0).alias("i"), F.lit(1).alias("o")) for d in outs.values()]
        return (reduce(DataFrame.unionAll, sides)
                .agg(F.coalesce(F.sum("i"), F.lit(0)).alias("n_in"), F.coalesce(F.sum("o"), F.lit(0)).alias("n_out"))
                .select(F.lit(name).alias("stage"), "n_in", "n_out",
                        (F.col("n_in") == F.col("n_out")).alias("balanced")))
    return reduce(DataFrame.unionAll, [counted(n, s, o) for n, (s, o) in stages.items()])


def reconcile_stream(seen: DataFrame, outputs: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """The same for stages of streams: `seen` (stage, batch_id, n_rows) tells what each
    micro-batch took in (`streaming.run.BatchCounts`), `outputs` what is stored. A
    micro-batch without a count, as a crash between its end and its report leaves one,
    is missing, and its stage not balanced: unknown is not the same as equal."""
    def stored(name: str, outs: Mapping[str, DataFrame]) -> DataFrame:
        return (reduce(DataFrame.unionAll, [d.select(F.lit(1).alias("o")) for d in outs.values()])
                .agg(F.count(F.lit(1)).alias("n_out")).select(F.lit(name).alias("stage"), "n_out"))
    told = seen.groupBy("stage").agg(F.count(F.lit(1)).alias("n_batches"), F.max("batch_id").alias("last"), F.sum("n_rows").alias("n_in"))
    both = reduce(DataFrame.unionAll, [stored(n, o) for n, o in outputs.items()]).join(told, "stage", "left")
    zero = F.lit(0).cast("bigint")
    batches, known = F.coalesce("n_batches", zero), F.coalesce("n_in", zero)
    missing = F.coalesce(F.col("last") + 1, zero) - batches
    return both.select("stage", batches.alias("n_batches"), missing.alias("n_missing"), known.alias("n_in"), "n_out",
                       ((known == F.col("n_out")) & (missing == 0)).alias("balanced"))


def watch(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Counts rows on the way through a job that runs anyway; read the
    observation after the action, instead of scanning again for `reconcile`."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen
