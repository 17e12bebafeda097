"""Labels of a stored atlas, read box by box where they are needed.

Annotation and hemisphere are two stored volumes of one shape. A task reads the same
box of both, so that their voxels are aligned by position: no voxel becomes a row
and nothing is joined on coordinates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtally.functions.boxes import block_rows
from voxtally.functions.coords import clamp, native_to_atlas
from voxtally.schema import HEMISPHERE_LEFT, HEMISPHERE_NA, HEMISPHERE_RIGHT, Shape
from voxtally.sources.reader import Volume


@dataclass(frozen=True)
class StoredLabels:
    """An annotation volume and, if there is one, its hemisphere volume."""

    annotation: Volume
    hemisphere: Volume | None = None

    def __post_init__(self):
        if self.hemisphere and self.hemisphere.meta.shape != self.annotation.meta.shape:
            raise ValueError(f"hemisphere volume is {self.hemisphere.meta.shape}, annotation is {self.annotation.meta.shape}")


def stored_labels(annotation: Volume, hemisphere: Volume | None = None) -> StoredLabels | None:
    """None where a box cannot be read on its own (images, compressed files of other writers) or shapes differ."""
    if annotation.box_reader() is None or (hemisphere and hemisphere.box_reader() is None):
        return None
    if hemisphere and hemisphere.meta.shape != annotation.meta.shape:
        return None
    return StoredLabels(annotation, hemisphere)


def count_region_voxels(labels: StoredLabels, midline: int | None = None) -> DataFrame:
    """``id, total_voxels, left_voxels, right_voxels``; with ``midline`` the side comes from ``x < midline``.

    Every stored box becomes one row for each region in it; only these counts are shuffled.
    """
    dtype = np.dtype(labels.annotation.meta.dtype).newbyteorder("<")
    sides = labels.hemisphere.box_reader() if labels.hemisphere and midline is None else None

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in block_rows(batch):
                start, size = [row[f"{a}0"] for a in "zyx"], [row[f"d{a}"] for a in "zyx"]
                ids, place = np.unique(np.frombuffer(row["data"], dtype), return_inverse=True)
                place = place.reshape(size)
                left = right = np.zeros(size, bool)
                if midline is not None:
                    left = np.broadcast_to(np.arange(start[2], start[2] + size[2]) < midline, size)
                    right = ~left
                elif sides:
                    side = sides(tuple((s, s + n) for s, n in zip(start, size)))
                    left, right = side == HEMISPHERE_LEFT, side == HEMISPHERE_RIGHT
                counts = [np.bincount(p, minlength=ids.size)[ids != 0] for p in (place.ravel(), place[left], place[right])]
                arrays = [pa.array(c.astype(np.int64)) for c in (ids[ids != 0], *counts)]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "total", "left", "right"])

    found = labels.annotation.blocks().mapInArrow(tally, "id bigint, total bigint, left bigint, right bigint")
    return found.groupBy("id").agg(*[F.sum(s).alias(f"{s}_voxels") for s in ("total", "left", "right")])


def find_labels(points: DataFrame, labels: StoredLabels, native: Shape) -> DataFrame:
    """Add ``found_region`` and ``found_hemisphere`` to each point, read from the box that it falls in.

    Points are dealt to tasks by stored box, a crowded box to several tasks; boxes
    without points are not read. Points without coordinates are background.
    """
    columns, shape, grid = points.columns, labels.annotation.meta.shape, labels.annotation.grid()
    counts = [-(-s // g) for s, g in zip(shape, grid)]
    at = [clamp(c, size).cast("bigint") for c, size in zip(native_to_atlas(native, shape), shape)]
    named = points.select("*", *[c.alias(f"_at_{a}") for a, c in zip("zyx", at)])
    cell = [F.expr(f"_at_{a} div {g}") for a, g in zip("zyx", grid)]
    placed = named.withColumn("_cell", (cell[0] * counts[1] + cell[1]) * counts[2] + cell[2])
    dealt = placed.filter("_cell is not null").repartitionByRange("_cell", F.xxhash64(*columns)).sortWithinPartitions("_cell")
    region, side = labels.annotation.box_reader(), labels.hemisphere.box_reader() if labels.hemisphere else None

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, start, boxes = None, None, []
        for batch in batches:
            cells = batch.column("_cell").to_numpy()
            where = [batch.column(f"_at_{a}").to_numpy() for a in "zyx"]
            found = np.zeros((2, cells.size), np.int64)
            found[1] = HEMISPHERE_NA
            edges = [*np.flatnonzero(np.diff(cells, prepend=-1)), cells.size]
            for first, end in zip(edges[:-1], edges[1:]):
                if cells[first] != held:
                    held = int(cells[first])
                    start = [i * g for i, g in zip(np.unravel_index(held, counts), grid)]
                    box = tuple((int(s), int(min(s + g, n))) for s, g, n in zip(start, grid, shape))
                    boxes = [read(box) for read in (region, side) if read]
                inside = tuple(w[first:end] - s for w, s in zip(where, start))
                for k, data in enumerate(boxes):
                    found[k, first:end] = data[inside]
            extra = [pa.array(found[0]).cast(pa.int32()), pa.array(found[1]).cast(pa.int8())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *extra], names=schema.names)

    extra = [T.StructField("found_region", T.IntegerType()), T.StructField("found_hemisphere", T.ByteType())]
    schema = T.StructType([*points.schema.fields, *extra])
    nowhere = placed.filter("_cell is null").select(*columns, F.lit(0).alias("found_region"), F.lit(HEMISPHERE_NA).cast("byte").alias("found_hemisphere"))
    return dealt.mapInArrow(look, schema).unionByName(nowhere)
