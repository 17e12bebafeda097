"""Point-in-mask tests and colocalisation reports."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtally.functions.coords import AXES, in_bounds
from voxtally.operators.structures import rollup_tiers
from voxtally.schema import coloc_column
from voxtally.sources.reader import Volume


def points_in_volume(points: DataFrame, mask: Volume, flag: str = "in_mask") -> DataFrame:
    """Flag each point that lies on a foreground voxel of a stored mask.

    Points are dealt to tasks by the storage box they lie in, a crowded box to
    several tasks; a task reads each of its boxes once and tests its points
    together. Boxes without points are never read and the mask is not shuffled.
    """
    read, grid, shape = mask.box_reader(), mask.grid(), mask.meta.shape
    columns = [c for c in points.columns if c != flag]
    counts = [-(-s // g) for s, g in zip(shape, grid)]
    cell = [F.expr(f"{a} div {g}") for a, g in zip(AXES, grid)]
    inside = in_bounds(shape)
    placed = points.select(*columns).withColumn("_cell", F.when(inside, (cell[0] * counts[1] + cell[1]) * counts[2] + cell[2]))
    tested = placed.filter("_cell is not null").repartitionByRange("_cell", F.xxhash64(*AXES)).sortWithinPartitions("_cell")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, data, start = None, None, None
        for batch in batches:
            cells = batch.column("_cell").to_numpy()
            at = [batch.column(a).to_numpy().astype(np.int64) for a in AXES]
            hit = np.zeros(cells.size, bool)
            edges = np.append(np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])), cells.size) if cells.size else [0]
            for first, end in zip(edges[:-1], edges[1:]):
                if cells[first] != held:
                    held = int(cells[first])
                    index = (held // (counts[1] * counts[2]), held // counts[2] % counts[1], held % counts[2])
                    start = [i * g for i, g in zip(index, grid)]
                    data = read(tuple((s, min(s + g, n)) for s, g, n in zip(start, grid, shape))) > 0
                hit[first:end] = data[tuple(a[first:end] - s for a, s in zip(at, start))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(hit)], names=[*columns, flag])

    schema = T.StructType([*[points.schema[c] for c in columns], T.StructField(flag, T.BooleanType())])
    outside = placed.filter("_cell is null").select(*columns, F.lit(False).alias(flag))
    return tested.mapInArrow(test, schema).unionByName(outside)


def points_in_mask(points: DataFrame, mask: DataFrame | Volume, flag: str = "in_mask") -> DataFrame:
    """Flag each point that lies on a foreground voxel of the mask.

    A stored volume with random access goes through :func:`points_in_volume`.
    Points outside the volume match nothing and are False, as are points on
    voxels that are not a number. A table with a ``value`` column is a volume,
    with one row per voxel; any other is made unique first, so that no point is
    duplicated. The join key packs Z and Y into one number, which keeps both sides
    plain shuffles that adaptive execution can split where points crowd on one voxel.
    """
    if not isinstance(mask, DataFrame):
        if mask.box_reader():
            return points_in_volume(points, mask, flag)
        mask = mask.voxels()
    found = F.col("value") > 0
    if "value" in mask.columns and mask.schema["value"].dataType.typeName() in ("double", "float"):
        found &= ~F.isnan("value")
    voxels = mask.filter(found) if "value" in mask.columns else mask.select(*AXES).distinct()
    packed = F.col("z").cast("bigint") * 2**32 + F.col("y")
    hits = voxels.select(packed.alias("_zy"), F.col("x").cast("int").alias("_x"), F.lit(True).alias("_hit"))
    columns = [c for c in points.columns if c != flag]
    return (
        points.select("*", packed.alias("_zy"), F.col("x").cast("int").alias("_x"))
        .join(hits, ["_zy", "_x"], "left")
        .select(*columns, F.col("_hit").isNotNull().alias(flag))
    )


def colocalize_pair(cells: DataFrame, larger: str, smaller: str, mask: DataFrame | Volume) -> DataFrame:
    """Set ``colocalized_with_<larger>`` on passed cells of the smaller channel.

    Only these are tested. Cells of the smaller channel that did not pass are
    reset to False; other channels keep the flag they had (False when it is new).
    """
    name = coloc_column(larger)
    before = F.coalesce(F.col(name), F.lit(False)) if name in cells.columns else F.lit(False)
    small = F.coalesce(F.col("biomarker") == smaller, F.lit(False))
    asked = small & F.coalesce(F.col("passed_filter"), F.lit(False))
    rest = cells.filter(~asked).withColumn(name, F.when(small, F.lit(False)).otherwise(before))
    return points_in_mask(cells.filter(asked), mask, name).unionByName(rest)


def colocalize_pairs(cells: DataFrame, pairs: list[tuple[str, str]], masks: dict[str, DataFrame | Volume]) -> DataFrame:
    for larger, smaller in pairs:
        cells = colocalize_pair(cells, larger, smaller, masks[larger])
    return cells


def _tested(cells: DataFrame, larger: str, smaller: str) -> DataFrame:
    name = coloc_column(larger)
    if name not in cells.columns:
        cells = cells.filter(F.lit(False)).withColumn(name, F.lit(False))
    return cells.filter((F.col("biomarker") == smaller) & F.col("passed_filter"))


def coloc_summary(cells: DataFrame, larger: str, smaller: str) -> DataFrame:
    """One row: tested and colocalised cells of the whole brain."""
    return _tested(cells, larger, smaller).agg(
        F.count(F.lit(1)).alias("tested"), F.count_if(F.col(coloc_column(larger))).alias("colocalized")
    )


def coloc_tallies(cells: DataFrame, larger: str, smaller: str) -> DataFrame:
    return (
        _tested(cells, larger, smaller)
        .filter(F.col("region_id").isNotNull())
        .groupBy(F.col("region_id").cast("bigint").alias("id"))
        .agg(
            F.count(F.lit(1)).alias("tested_cells"),
            F.count_if(F.col(coloc_column(larger))).alias("colocalized_cells"),
        )
    )


def tiered_coloc_report(cells: DataFrame, structures: DataFrame, larger: str, smaller: str) -> DataFrame:
    """Roll the tallies up the ontology; the rate is NULL where nothing was tested."""
    rolled = rollup_tiers(coloc_tallies(cells, larger, smaller), structures, ["tested_cells", "colocalized_cells"])
    rate = F.try_divide(F.col("colocalized_cells"), F.col("tested_cells"))
    return rolled.withColumn("colocalization_rate", rate)
