"""Small time helpers as columns."""

from pyspark.sql import Column, functions as F


def micros(col: str | Column) -> Column:
    """Microseconds since the epoch (session zone UTC) for either timestamp type."""
    return F.unix_micros((F.col(col) if isinstance(col, str) else col).cast("timestamp"))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(1_000_000.0)


def floor_div(value: Column, width: int) -> Column:
    """Floor of value / width in bigint arithmetic, right for negative values too."""
    return ((value - F.pmod(value, F.lit(width))) / F.lit(width)).cast("bigint")


def bucket(col: str | Column, width_seconds: float, shift_seconds: float = 0.0) -> Column:
    """Number of the fixed-width time bucket that holds col + shift."""
    return floor_div(micros(col) + F.lit(round(shift_seconds * 1_000_000)), round(width_seconds * 1_000_000))
