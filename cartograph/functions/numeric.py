"""Numeric column helpers: scaling, clamping, distances and argmin over a few centres."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A column whose spread is below this is treated as constant (range 1.0 -> scaled 0.0).
RANGE_EPSILON = 1e-12


def clamp01(col: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), col))


def safe_range(lo: Column, hi: Column, eps: float = RANGE_EPSILON) -> Column:
    spread = hi - lo
    return F.when(spread < F.lit(eps), F.lit(1.0)).otherwise(spread)


def minmax_scaled(x: Column, lo: Column, hi: Column) -> Column:
    """(x - lo) / range clamped to [0, 1]; a constant column scales to 0.0 (not 0.5)."""
    return clamp01((x - lo) / safe_range(lo, hi))


def euclidean_distance(cols: Sequence[Column], point: Column) -> Column:
    """Distance to a point given as an array column."""
    total = None
    for i, c in enumerate(cols):
        d = c - F.get(point, F.lit(i))
        total = d * d if total is None else total + d * d
    return F.sqrt(total)


def argmin_struct(points: Column, cols: Sequence[Column]) -> Column:
    """Index ``i`` of the nearest of an array of (i, c); ties go to the lowest, NaN never wins.

    ``array_min`` over (distance, index) structs orders by distance, then index; Spark
    orders NaN above every number, so a NaN distance loses to any real one and an
    all-NaN row yields index 0.
    """
    far = F.transform(points, lambda p: F.struct(euclidean_distance(cols, p["c"]).alias("d"), p["i"].alias("i")))
    return F.array_min(far).getField("i")


def significant(col: Column, digits: int) -> Column:
    """A double rounded to that many significant decimal digits."""
    return F.format_string(f"%.{digits - 1}e", col).cast("double")
