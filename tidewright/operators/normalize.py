"""Normalisation: one schema, one set of units, texts and times."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import geo
from ..functions.skew import unique_lookup


def conform(df: DataFrame, schema: T.StructType, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Exactly the schema's columns, in its order: renamed (new name -> old name),
    cast without raising, null where absent."""
    rename = rename or {}
    have = set(df.columns)

    def column(f: T.StructField) -> Column:
        old = rename.get(f.name, f.name)
        value = F.col(old).try_cast(f.dataType) if old in have else F.lit(None).cast(f.dataType)
        return value.alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def null_sentinels(df: DataFrame, codes: Mapping[str, Sequence]) -> DataFrame:
    """"Not available" codes to null."""
    return df.withColumns({c: F.when(~F.col(c).isin(list(v)), F.col(c)) for c, v in codes.items()})


def scale_units(df: DataFrame, units: Mapping[str, tuple[float, float]]) -> DataFrame:
    """value * factor + offset."""
    return df.withColumns({c: F.col(c) * F.lit(f) + F.lit(o) for c, (f, o) in units.items()})


def normalize_text(df: DataFrame, cols: Sequence[str], padding: str = "@") -> DataFrame:
    """Padding characters to blanks, blanks single, ends trimmed, upper case; empty is null."""
    def clean(c: str) -> Column:
        text = F.translate(c, padding, " " * len(padding))
        return F.nullif(F.upper(F.trim(F.regexp_replace(text, r"\s+", " "))), F.lit(""))
    return df.withColumns({c: clean(c) for c in cols})


def normalize_time(df: DataFrame, col: str, patterns: Sequence[str], tz: str = "UTC",
                   out: str | None = None) -> DataFrame:
    """Text in any of the patterns to a UTC instant (first that fits wins). Texts
    without an offset are wall-clock times in `tz`."""
    def parsed(p: str) -> Column:
        at = F.try_to_timestamp(F.col(col), F.lit(p))
        zoned = re.search(r"[XxZzVO]", re.sub(r"'[^']*'", "", p))
        return at if zoned else F.to_utc_timestamp(at, tz)
    return df.withColumn(out or col, F.coalesce(*[parsed(p) for p in patterns]))


def map_codes(df: DataFrame, codes: DataFrame, on: str, default=None, value: str = "value") -> DataFrame:
    """Replaces nothing, adds `value`: the code's meaning, or the default."""
    found = unique_lookup(df, codes.select(on, value), [on])
    return found.withColumn(value, F.coalesce(value, F.lit(default))) if default is not None else found


def union_sources(*dfs: DataFrame) -> DataFrame:
    """All rows, columns matched by name, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def wrap_angles(df: DataFrame, lon: str | None = None, course: str | None = None) -> DataFrame:
    """Longitude to [-180, 180), course to [0, 360)."""
    new = {}
    if lon:
        new[lon] = geo.wrap_lon(F.col(lon))
    if course:
        new[course] = geo.wrap_course(F.col(course))
    return df.withColumns(new)
