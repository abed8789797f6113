"""Ways to keep hot keys from landing in one task.

Sizes are checked by bounded jobs (a top-N report, a limited count), never by
pulling data to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class HotKeys:
    """When a key counts as hot.

    Keys holding more than `min_rows` rows are looked for among the `max_keys`
    heaviest; any key outside those holds at most 1/max_keys of all rows.
    """

    min_rows: int = 5_000_000
    max_keys: int = 10_000


DEFAULT_HOT = HotKeys()

# What operators take as `hot`: HotKeys, cut points made earlier (ordered.OrderedCut),
# or None where no key can be hot.
Hot = Any


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS,
                   max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the whole table is small. Counted by an ordinary aggregate: one row
    per task travels, whatever the table's size."""
    size = (df.select(F.octet_length(F.to_json(F.struct("*"))).alias("b"))
              .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"))
              .first())
    return size["n"] <= max_rows and size["b"] <= max_bytes


def heavy_keys(df: DataFrame, keys: Sequence[str], hot: HotKeys = DEFAULT_HOT) -> list:
    """Rows (keys…, n) of the hot keys: one map-side combined count, at most
    `max_keys` rows returned."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > hot.min_rows)
              .orderBy(F.desc("n")).limit(hot.max_keys)
              .collect())


def unique_lookup(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                  hot: Hot = DEFAULT_HOT, null_safe: bool = False,
                  small: bool | None = None) -> DataFrame:
    """Join to a right side that has at most one row per key.

    Small right side: broadcast, after measuring it. Otherwise the hot left keys
    (few, by construction) are looked up by broadcasting only their right rows,
    and the rest goes through an ordinary shuffle join with no hot key in it.
    `small` passes on a size already known. A streaming left side cannot be measured for hot keys and takes the plain join.
    """
    on = list(on)

    def joined(l: DataFrame, r: DataFrame) -> DataFrame:
        if not null_safe:
            return l.join(r, on, how)
        r = r.withColumnsRenamed({k: f"__r_{k}" for k in on})
        cond = F.lit(True)
        for k in on:
            cond = cond & l[k].eqNullSafe(r[f"__r_{k}"])
        return l.join(r, cond, how).drop(*[f"__r_{k}" for k in on])

    if fits_broadcast(right) if small is None else small:
        return joined(left, F.broadcast(right))
    policy = getattr(hot, "hot", hot)
    if left.isStreaming or policy is None:
        return joined(left, right)
    hot_rows = heavy_keys(left, on, policy)
    if not hot_rows:
        return joined(left, right)
    schema = left.select(*on).schema
    keys = left.sparkSession.createDataFrame([tuple(r[k] for k in on) for r in hot_rows], schema)
    keys = F.broadcast(keys.withColumnsRenamed({k: f"__h_{k}" for k in on}))

    def side(df: DataFrame, kind: str) -> DataFrame:
        cond = F.lit(True)
        for k in on:
            cond = cond & df[k].eqNullSafe(keys[f"__h_{k}"])
        return df.join(keys, cond, kind)

    hot_right = side(right, "left_semi")
    if not fits_broadcast(hot_right):  # wide reference rows: a join that adaptive execution can split
        return joined(left, right)
    hot_part = joined(side(left, "left_semi"), F.broadcast(hot_right))
    rest = joined(side(left, "left_anti"), right)
    return hot_part.unionByName(rest)


CROWD = 100_000
COPIES = 8
ROW, COLUMN = "__row", "__column"


def spread_crowds(a: DataFrame, b: DataFrame, a_keys: Sequence[str], b_keys: Sequence[str], limit: int | None = CROWD,
                  both: bool = True, copies: int = COPIES) -> tuple[DataFrame, DataFrame]:
    """The two sides of an equi-join with `ROW` and `COLUMN` added, to be joined on as well:
    of a key with more than `limit` rows the pairs become a grid of parts. A row of `a` goes
    to one part of its side by a hash of all its columns and is copied to each part of the
    other, and a row of `b` the other way round, so that every pair meets once, in a task
    that reads about `limit` rows of each. With `both` off only `a` is cut, and a row of `a`
    still meets all its partners in one place, as outer, semi and anti joins need it.

    Keys are counted by one map-side combined pass over each side cut. The crowded ones are
    stored and broadcast: if they are more than BROADCAST_ROWS, only those that hold more
    than that share of all crowded rows, which cannot be more than BROADCAST_ROWS. Equal
    rows share a part.

    Copies stay in proportion to the rows: where keys are crowded on both sides by so many
    that parts of `limit` rows would need more than COPIES copies of each, parts are larger.
    With fewer `copies` parts of up to CROWD rows may be larger for their sake.
    """
    if limit is None:
        return a.withColumns({ROW: F.lit(0), COLUMN: F.lit(0)}), b.withColumns({ROW: F.lit(0), COLUMN: F.lit(0)})
    a_found, b_found = _crowds(a, a_keys, limit), _crowds(b, b_keys, limit) if both else None
    if a_found is not None and b_found is not None:
        least = _affordable(a_found, b_found, len(a_keys))
        limit = max(limit, least, min(CROWD, -(-least * COPIES // copies)))
    a_crowds, b_crowds = _parts(a_found, a_keys, limit), _parts(b_found, b_keys, limit)
    return (_dealt(_dealt(a, a_keys, a_crowds, ROW, one=True), a_keys, b_crowds, COLUMN, one=False),
            _dealt(_dealt(b, b_keys, b_crowds, COLUMN, one=True), b_keys, a_crowds, ROW, one=False))


def _crowds(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame | None:
    """(__k0…, __n) of the keys with more than `limit` rows, stored; None if there are none."""
    counted = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("__n"))
    found = cut_lineage(counted.filter(F.col("__n") > limit))
    return None if found.isEmpty() else found


def _affordable(a: DataFrame, b: DataFrame, n_keys: int) -> int:
    """Rows of a part at which keys crowded on both sides are copied COPIES times on average."""
    keys = [f"__k{i}" for i in range(n_keys)]
    rows = sum(side.agg(F.sum("__n")).first()[0] for side in (a, b))
    pairs = a.join(b.withColumnRenamed("__n", "__m"), keys).agg(F.sum(F.col("__n").cast("double") * F.col("__m"))).first()[0] or 0
    return math.ceil(2 * pairs / (COPIES * rows))


def _parts(found: DataFrame | None, keys: Sequence[str], limit: int) -> DataFrame | None:
    """(__k0…, __parts) of the keys to be cut."""
    if found is None:
        return None
    size = found.filter(F.col("__n") > limit).agg(F.count(F.lit(1)).alias("n"), F.sum("__n").alias("rows")).first()
    if not size["n"]:
        return None
    if size["n"] > BROADCAST_ROWS:
        limit = max(limit, -(-size["rows"] // BROADCAST_ROWS))
    parts = F.ceil(F.col("__n") / limit).cast("int").alias("__parts")
    return found.filter(F.col("__n") > limit).select(*[f"__k{i}" for i in range(len(keys))], parts)


def _dealt(df: DataFrame, keys: Sequence[str], crowds: DataFrame | None, out: str, one: bool) -> DataFrame:
    """Adds `out`: a row's part of its crowd (`one`), or all parts, a copy each."""
    if crowds is None:
        return df.withColumn(out, F.lit(0))
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"__k{i}"))
    held = df.join(F.broadcast(crowds), same, "left")
    parts = F.coalesce("__parts", F.lit(1))
    if one:
        part = F.when(parts > 1, F.pmod(F.xxhash64(*plain), parts).cast("int")).otherwise(0)
    else:
        part = F.explode(F.sequence(F.lit(0), parts - 1))
    return held.withColumn(out, part).drop("__parts", *[f"__k{i}" for i in range(len(keys))])
