"""Operators on sparse voxel tables ``(z, y, x, value)``.

A voxel that is absent has value 0, so every operator keeps non-zero rows only.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtally.functions.coords import AXES, in_bounds, native_to_atlas, permute, permute_shape
from voxtally.operators.structures import Region, subtree_ids
from voxtally.schema import Box, Shape


def crop(voxels: DataFrame, lo: Shape, hi: Shape) -> DataFrame:
    """Half-open sub-volume, re-based to its own origin; empty when an extent is."""
    kept = voxels
    for axis, a, b in zip(AXES, lo, hi):
        kept = kept.filter((F.col(axis) >= a) & (F.col(axis) < b))
    return kept.withColumns({axis: F.col(axis) - a for axis, a in zip(AXES, lo)})


def drop_outside(points: DataFrame, shape: Shape) -> DataFrame:
    return points.filter(in_bounds(shape))


def outside_count(points: DataFrame, shape: Shape) -> DataFrame:
    inside = F.count_if(in_bounds(shape))
    return points.agg(inside.alias("kept"), (F.count(F.lit(1)) - inside).alias("dropped"))


def relabel(voxels: DataFrame, ids: DataFrame, target: int) -> DataFrame:
    """Voxels whose value is one of ``ids``, all set to ``target``."""
    keep = ids.select(F.col("id").alias("value"))
    return voxels.join(keep, "value", "left_semi").select(*AXES, F.lit(target).cast("bigint").alias("value"))


def select_region(voxels: DataFrame, structures: DataFrame, region: Region) -> DataFrame:
    return relabel(voxels, subtree_ids(structures, region), region.id)


def _div(a: Column, b: int) -> Column:
    """Floor division of a non-negative column."""
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def _nearest_targets(axis: str, source: int, target: int) -> Column:
    """Target indices that read this source index.

    Target j reads source ``floor((j + 1/2) * source / target)``; solved for j
    this is one range per source index, so no join is needed.
    """
    i = F.col(axis).cast("bigint")
    first = _div(i * (2 * target) + source - 1, 2 * source)
    end = _div((i + 1) * (2 * target) + source - 1, 2 * source)
    return F.when(end > first, F.sequence(first, end - 1)).otherwise(F.array()).cast("array<int>")


def resample_nearest(voxels: DataFrame, source: Shape, target: Shape) -> DataFrame:
    """Order-0 resize: a narrow explode per axis, without any shuffle."""
    out = voxels
    for axis, s, t in zip(AXES, source, target):
        if s != t:
            out = out.withColumn(axis, F.explode(_nearest_targets(axis, s, t)))
    return out


def _linear_step(voxels: DataFrame, axis: str, n: int, t: int) -> DataFrame:
    """Send each voxel along one axis to the targets that read it, times weight * 2t.

    Target j reads position ``((2j + 1) n - t) / (2t)``, mirrored at both ends.
    Weights are integers, so sums are exact and do not depend on row order.
    """
    i, unit = F.col(axis).cast("bigint"), 2 * t
    if n == 1:
        low, high = F.lit(0), F.lit(t - 1)
    else:
        first = (2 * i - 1) * t - n
        low = F.when((i <= 1) | (first < 0), 0).otherwise(_div(first, 2 * n) + 1)
        last = (2 * i + 3) * t - n - 1
        high = F.when(i >= n - 2, t - 1).when(last < 0, -1).otherwise(F.least(F.lit(t - 1), _div(last, 2 * n)))
    j = F.col("_j").cast("bigint")
    pos = F.abs((2 * j + 1) * n - t)
    pos = F.lit(0) if n == 1 else F.when(pos > (n - 1) * unit, 2 * (n - 1) * unit - pos).otherwise(pos)
    weight = unit - F.abs(pos - i * unit)
    spread = voxels.withColumn("_j", F.explode(F.when(high >= low, F.sequence(low, high))))
    kept = spread.withColumn("_w", weight).filter("_w > 0")
    return kept.withColumns({axis: F.col("_j").cast("int"), "value": F.col("value") * F.col("_w")}).drop("_j", "_w")


def _linear_pass(voxels: DataFrame, steps: list[tuple[str, int, int]]) -> DataFrame:
    """One truncating pass over some axes.

    Axes that shrink are summed up together, with partial sums before the shuffle.
    Along an axis that grows, the voxels of each line are brought together before
    they spread, so that what is shuffled is never larger than what goes in.
    """
    steps = [s for s in steps if s[1] != s[2]]
    if not steps:
        return voxels
    total, out, scale = F.sum("value").alias("value"), voxels, 1
    shrinking = [s for s in steps if s[1] > s[2]]
    for axis, n, t in shrinking:
        out, scale = _linear_step(out, axis, n, t), scale * 2 * t
    if shrinking:
        out = out.groupBy(*AXES).agg(total)
    for axis, n, t in steps:
        if n < t:
            lines = out.repartition(*[a for a in AXES if a != axis])
            out, scale = _linear_step(lines, axis, n, t).groupBy(*AXES).agg(total), scale * 2 * t
    shares = F.call_function("div", F.col("value"), F.lit(scale).cast("bigint"))
    return out.select(*AXES, shares.alias("value")).filter("value <> 0")


def resample_linear(voxels: DataFrame, source: Shape, target: Shape) -> DataFrame:
    """Order-1 resize of integer intensities in two passes, XY and then Z.

    Each pass truncates to an integer.
    """
    z, y, x = [(a, s, t) for a, s, t in zip(AXES, source, target)]
    return _linear_pass(_linear_pass(voxels, [x, y]), [z])


def resample(voxels: DataFrame, source: Shape, target: Shape, order: int = 0) -> DataFrame:
    if order not in (0, 1):
        raise ValueError(f"resize order must be 0 or 1, got {order}")
    return (resample_nearest if order == 0 else resample_linear)(voxels, source, target)


def _linear_window(first: int, end: int, n: int, t: int) -> tuple[int, int, np.ndarray]:
    """Source range that the targets ``first..end`` of one axis read, and their weights * 2t on it (1 where n is t)."""
    if n == t:
        return first, end, np.eye(end - first, dtype=np.int64)
    j, top = np.arange(first, end, dtype=np.int64), (n - 1) * 2 * t
    pos = np.abs((2 * j + 1) * n - t) if n > 1 else np.zeros_like(j)
    pos = np.where(pos > top, 2 * top - pos, pos)
    low, high = int(pos.min() // (2 * t)), min(n, int(-(-pos.max() // (2 * t))) + 1)
    return low, high, np.maximum(0, 2 * t - np.abs(pos[:, None] - np.arange(low, high) * 2 * t))


def _shares(total: np.ndarray, scale: int) -> np.ndarray:
    """Weighted sums back to values; whole numbers are truncated."""
    return total / scale if total.dtype.kind == "f" else np.sign(total) * (np.abs(total) // scale)


def resized_box(read: Callable[[Box], np.ndarray], source: Shape, target: Shape, box: Box, order: int = 0) -> np.ndarray:
    """One box of a resized volume, from the source box it needs.

    Order 0 takes the voxel under each target's centre. Order 1 weighs the
    neighbours along Y and X, then along Z; each pass truncates whole numbers.
    Boxes can be made in any order and anywhere: none needs another.
    """
    if order not in (0, 1):
        raise ValueError(f"resize order must be 0 or 1, got {order}")
    if order == 0:
        picks = [(2 * np.arange(a, b) + 1) * n // (2 * t) for (a, b), n, t in zip(box, source, target)]
        starts = [int(p[0]) for p in picks]
        data = read(tuple((s, int(p[-1]) + 1) for s, p in zip(starts, picks)))
        return data[np.ix_(*[p - s for p, s in zip(picks, starts)])]
    windows = [_linear_window(a, b, n, t) for (a, b), n, t in zip(box, source, target)]
    data = read(tuple((low, high) for low, high, _ in windows))
    kind = np.float64 if data.dtype.kind == "f" else np.int64
    wz, wy, wx = (w.astype(kind) for _, _, w in windows)
    scales = [1 if n == t else 2 * t for n, t in zip(source, target)]
    planes = _shares(np.stack([wy @ plane @ wx.T for plane in data.astype(kind)]), scales[1] * scales[2])
    return _shares(np.tensordot(wz, planes, axes=1), scales[0]).astype(data.dtype)


def pyramid_shapes(shape: Shape, levels: int = 5, factor: int = 2) -> list[Shape]:
    """Shape of each level; a side never drops below one voxel."""
    shapes = [tuple(shape)]
    for _ in range(levels - 1):
        shapes.append(tuple(max(1, s // factor) for s in shapes[-1]))
    return shapes


def pyramid(voxels: DataFrame, shape: Shape, levels: int = 5, factor: int = 2, order: int = 0) -> list[DataFrame]:
    """Levels 0..n-1, each resampled from the one before."""
    out = [voxels]
    shapes = pyramid_shapes(shape, levels, factor)
    for source, target in zip(shapes, shapes[1:]):
        out.append(resample(out[-1], source, target, order))
    return out


def registration_shape(shape: Shape, factor: Shape) -> Shape:
    return tuple(max(1, s // f) for s, f in zip(shape, factor))


def registration_input(voxels: DataFrame, shape: Shape, factor: Shape, order, resize_order: int = 1) -> tuple[DataFrame, Shape]:
    """Downsample in native axis order, then permute the axes."""
    small = registration_shape(shape, factor)
    return permute(resample(voxels, shape, small, resize_order), order), permute_shape(small, order)


def scatter(points: DataFrame, shape: Shape, value: int = 255) -> DataFrame:
    """In-bounds points painted as voxels; points on one voxel paint it once."""
    inside = drop_outside(points, shape).select(*[F.col(a).cast("int").alias(a) for a in AXES])
    return inside.distinct().withColumn("value", F.lit(value).cast("bigint"))


def _passed(cells: DataFrame, biomarker: str) -> DataFrame:
    return cells.filter((F.col("biomarker") == biomarker) & F.col("passed_filter"))


def redraw_native(cells: DataFrame, biomarker: str, shape: Shape, value: int = 255) -> DataFrame:
    return scatter(_passed(cells, biomarker), shape, value)


def redraw_atlas(cells: DataFrame, biomarker: str, native: Shape, atlas: Shape, value: int = 255) -> DataFrame:
    """Cells scaled to atlas space; those outside are dropped, not clamped."""
    scaled = native_to_atlas(native, atlas)
    points = _passed(cells, biomarker).select(*[c.alias(a) for a, c in zip(AXES, scaled)])
    return scatter(points, atlas, value)
