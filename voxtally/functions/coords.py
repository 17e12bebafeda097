"""Coordinate arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtally.schema import Shape

AXES = ("z", "y", "x")


def scale_axis(p: Column, source: int, target: int) -> Column:
    """``p * target // source`` with floor semantics for negative input too."""
    scaled = p.cast("bigint") * F.lit(target).cast("bigint")
    n = F.lit(source).cast("bigint")
    return F.call_function("div", scaled - F.pmod(scaled, n), n)


def native_to_atlas(source: Shape, target: Shape, columns=AXES) -> list[Column]:
    return [scale_axis(F.col(c), s, t) for c, s, t in zip(columns, source, target)]


def clamp(v: Column, size: int) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), F.least(v, F.lit(size - 1).cast("bigint")))


def in_bounds(shape: Shape, columns=AXES) -> Column:
    inside = F.lit(True)
    for name, size in zip(columns, shape):
        inside = inside & F.col(name).between(0, size - 1)
    return inside


def check_order(order) -> tuple[int, int, int]:
    axes = tuple(int(a) for a in order)
    if len(axes) != 3 or sorted(axes) != [0, 1, 2]:
        raise ValueError(f"transpose order must be a permutation of 0, 1, 2, got {order!r}")
    return axes


def invert_order(order) -> tuple[int, int, int]:
    axes = check_order(order)
    return tuple(axes.index(i) for i in range(3))


def is_self_inverse(order) -> bool:
    return invert_order(order) == check_order(order)


def permute_shape(shape: Shape, order) -> Shape:
    return tuple(shape[a] for a in check_order(order))


def permute(voxels: DataFrame, order) -> DataFrame:
    """Rename coordinate columns so that logical axis i is raw axis order[i]."""
    axes = check_order(order)
    rest = [c for c in voxels.columns if c not in AXES]
    return voxels.select(*[F.col(AXES[a]).alias(AXES[i]) for i, a in enumerate(axes)], *rest)
