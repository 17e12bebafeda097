"""Native-to-atlas lookup of region and hemisphere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtally.functions.coords import AXES, clamp, native_to_atlas
from voxtally.operators.stored_labels import StoredLabels, find_labels
from voxtally.schema import HEMISPHERE_NA, Shape


def label_table(annotation: DataFrame, hemisphere: DataFrame | None = None) -> DataFrame:
    """Sparse ``(z, y, x, region_id, hemisphere_id)`` from two voxel tables.

    A voxel may carry a hemisphere without a region and the other way round, so
    the two tables are aligned with a full outer join on the coordinates.
    """
    regions = annotation.select(*AXES, F.col("value").alias("region_id"))
    if hemisphere is None:
        return regions.withColumn("hemisphere_id", F.lit(HEMISPHERE_NA))
    sides = hemisphere.select(*AXES, F.col("value").alias("hemisphere_id"))
    return regions.join(sides, list(AXES), "full").select(
        *AXES,
        F.coalesce("region_id", F.lit(0).cast("bigint")).alias("region_id"),
        F.coalesce("hemisphere_id", F.lit(HEMISPHERE_NA).cast("bigint")).alias("hemisphere_id"),
    )


def lookup_labels(points: DataFrame, labels: DataFrame | StoredLabels, native: Shape, atlas: Shape) -> DataFrame:
    """Add ``found_region`` and ``found_hemisphere`` to each point.

    Scaled coordinates are clamped into the atlas, so every point reads one
    voxel; a voxel missing from the sparse table is background, label 0. The
    left equi-join runs on the voxel's raster index, unique on the right: Spark
    broadcasts the labels when they are below its size threshold, and otherwise
    shuffles both sides, where adaptive execution splits crowded atlas voxels.
    Stored labels are looked up inside the box of each point, without that join.
    """
    if isinstance(labels, StoredLabels):
        if labels.annotation.meta.shape != tuple(atlas):
            raise ValueError(f"the stored atlas is {labels.annotation.meta.shape}, not {tuple(atlas)}")
        return find_labels(points, labels, native)
    z, y, x = [clamp(c, size) for c, size in zip(native_to_atlas(native, atlas), atlas)]
    key = (z * atlas[1] + y) * atlas[2] + x
    at = (F.col("z").cast("bigint") * atlas[1] + F.col("y")) * atlas[2] + F.col("x")
    right = labels.select(
        at.alias("_voxel"), F.col("region_id").cast("int").alias("_region"), F.col("hemisphere_id").cast("byte").alias("_side")
    )
    return (
        points.select("*", key.alias("_voxel"))
        .join(right, "_voxel", "left")
        .select(
            *points.columns,
            F.coalesce("_region", F.lit(0)).alias("found_region"),
            F.coalesce("_side", F.lit(HEMISPHERE_NA).cast("byte")).alias("found_hemisphere"),
        )
    )


def _selected(biomarker: str | None) -> Column:
    return F.lit(True) if biomarker is None else F.col("biomarker") == biomarker


def assign_regions(
    cells: DataFrame,
    labels: DataFrame | StoredLabels,
    native: Shape,
    atlas: Shape,
    biomarker: str | None = None,
    cells_midline: bool = False,
) -> DataFrame:
    """Fill ``region_id`` and ``hemisphere_id`` of one biomarker's cells.

    Cells are assigned whether or not they passed the filter; all other rows and
    every extra column stay as they are. ``cells_midline`` derives the side from
    the atlas X midline instead, for brains without a hemisphere volume.
    """
    side = F.col("found_hemisphere")
    if cells_midline:
        ax = clamp(native_to_atlas(native, atlas)[2], atlas[2])
        side = F.when(ax < atlas[2] // 2, 1).otherwise(2).cast("byte")
    sel = _selected(biomarker)
    found = lookup_labels(cells, labels, native, atlas)
    return found.withColumns(
        {
            "region_id": F.when(sel, F.col("found_region")).otherwise(F.col("region_id")),
            "hemisphere_id": F.when(sel, side).otherwise(F.col("hemisphere_id")),
        }
    ).drop("found_region", "found_hemisphere")


def assigned_count(cells: DataFrame, biomarker: str | None = None) -> DataFrame:
    return cells.filter(_selected(biomarker)).agg(F.count(F.lit(1)).alias("assigned"))
