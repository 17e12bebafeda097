"""Density and left/right asymmetry expressions.

Undefined results (0/0, or a structure without geometry) are NULL rather than
NaN, because Spark sorts and compares NaN as the largest number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIGNIFICANT_PERCENT = 30.0


def density(count: Column, volume: Column) -> Column:
    infinite = F.when(count > 0, F.lit(float("inf")))
    return F.when(volume == 0, infinite).otherwise(F.try_divide(count.cast("double"), volume))


def round_half_even(v: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.rint(v * scale) / scale


def diff_percent(left: Column, right: Column) -> Column:
    ratio = F.try_divide(left - right, right) * 100
    undefined = right.isNull() | (right == float("inf"))
    value = (
        F.when(undefined, F.lit(None).cast("double"))
        .when(right != 0, ratio)
        .when(left > 0, F.lit(100.0))
        .otherwise(F.lit(0.0))
    )
    return round_half_even(value, 2)


def dominant_side(left: Column, right: Column) -> Column:
    return F.when(left > right, "Left").when(left < right, "Right").otherwise("None")


def significant(abs_diff: Column) -> Column:
    return F.coalesce(abs_diff >= SIGNIFICANT_PERCENT, F.lit(False))
