"""Cell detection: 3-D connected components with centroid and size.

Each box of the volume is labelled inside one task; only sums and face voxels
leave it. Faces are matched with an equi-join on the voxel's raster index, the
resulting contact graph is reduced to stars, and the sums are added per star.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtally.functions.boxes import block_rows, label_box
from voxtally.operators.graph import connected_components
from voxtally.schema import CELL_SCHEMA, HEMISPHERE_NA, Shape, VolumeMeta
from voxtally.session import cut_lineage

PARTIAL_DDL = (
    "root bigint, n bigint, sz bigint, sy bigint, sx bigint, "
    "border array<bigint>, reach array<bigint>, carry array<bigint>"
)
_BIG_LIST = pa.list_(pa.int64())
_PARTIAL_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("root", "n", "sz", "sy", "sx")] + [(c, _BIG_LIST) for c in ("border", "reach", "carry")]
)

# Brick edge for voxel tables; at most 64, so that a brick's X row fits in one word.
BRICK = 64
# Longest side of a box labelled at once when the input is dense.
LABEL_SIDE = 128
# Cells numbered by one task; the numbers do not depend on it.
ROWS_PER_RANGE = 500_000


def _partial_table(found: dict) -> pa.Table:
    columns = []
    for field in _PARTIAL_ARROW:
        values = found[field.name]
        if field.type == _BIG_LIST:
            ends = np.cumsum([0] + [len(v) for v in values]).astype(np.int32)
            flat = np.concatenate(values) if len(values) else np.empty(0, np.int64)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64())))
        else:
            columns.append(pa.array(values, pa.int64()))
    return pa.Table.from_arrays(columns, schema=_PARTIAL_ARROW)


def label_voxels(voxels: DataFrame, shape: Shape, connectivity: int, z_chunk: int | None = None, brick: int | None = None) -> DataFrame:
    """Partial components of a sparse voxel table, one brick per group.

    The voxels of each X row of a brick are first OR-ed into one 64-bit word.
    That aggregation runs before the shuffle, so repeated voxels cost nothing
    and a brick never has more than ``brick`` * ``brick`` words (at most 64 a side).
    """
    side = brick or BRICK
    depth = side if z_chunk is None else z_chunk
    keys = {
        "_bz": F.expr(f"cast(z div {depth} as int)"),
        "_cz": F.expr(f"cast((z % {depth}) div {side} as int)"),
        "_by": F.expr(f"cast(y div {side} as int)"),
        "_bx": F.expr(f"cast(x div {side} as int)"),
        "z": F.col("z").cast("int"),
        "y": F.col("y").cast("int"),
    }
    bit = F.expr(f"shiftleft(1L, cast(x % {side} as int))")
    words = voxels.select(*[c.alias(k) for k, c in keys.items()], bit.alias("bit")).groupBy(*keys).agg(F.bit_or("bit").alias("word"))

    def label(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bz, cz, by, bx = (k.as_py() for k in key)
        z0, y0, x0 = bz * depth + cz * side, by * side, bx * side
        box = np.zeros((min(side, (bz + 1) * depth - z0), side, side), dtype=bool)
        for batch in batches:
            z, y, word = (batch.column(c).to_numpy() for c in ("z", "y", "word"))
            bits = np.unpackbits(word.astype("<i8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
            box[z - z0, y - y0] = bits[:, :side]
        yield from _partial_table(label_box(box, (z0, y0, x0), shape, connectivity, z_chunk)).to_batches()

    return words.groupBy("_bz", "_cz", "_by", "_bx").applyInArrow(label, PARTIAL_DDL)


def label_blocks(blocks: DataFrame, meta: VolumeMeta, connectivity: int, z_chunk: int | None = None) -> DataFrame:
    """Partial components of dense blocks; no shuffle, one bounded box at a time.

    Blocks must tile the volume. They are cut to at most LABEL_SIDE voxels a
    side, and with ``z_chunk`` also where they cross a chunk boundary.
    """
    shape, dtype, side = meta.shape, np.dtype(meta.dtype), LABEL_SIDE

    def cuts(start: int, size: int, chunk: int | None = None) -> list[tuple[int, int]]:
        at = {start, start + size, *range(start, start + size, side)}
        if chunk:
            at |= set(range(start + -start % chunk, start + size, chunk))
        marks = sorted(at)
        return list(zip(marks, marks[1:]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in block_rows(batch):
                start, size = (r["z0"], r["y0"], r["x0"]), (r["dz"], r["dy"], r["dx"])
                box = np.frombuffer(r["data"], dtype=dtype).reshape(size) > 0
                spans = [cuts(s, n, c) for s, n, c in zip(start, size, (z_chunk, None, None))]
                for part in product(*spans):
                    piece = box[tuple(slice(a - s, b - s) for (a, b), s in zip(part, start))]
                    found = label_box(piece, [a for a, _ in part], shape, connectivity, z_chunk)
                    yield from _partial_table(found).to_batches()

    return blocks.mapInArrow(label, PARTIAL_DDL)


def _contacts(partials: DataFrame, column: str) -> DataFrame:
    """Pairs of partial components that meet across a face, with the voxel met."""
    faces = partials.select(F.col("root").alias("b"), F.explode("border").alias("voxel"))
    return partials.select(F.col("root").alias("a"), F.explode(column).alias("voxel")).join(faces, "voxel")


def join_partials(partials: DataFrame, chunked: bool = False) -> DataFrame:
    """Add up partial components into whole ones: ``root, n, sz, sy, sx``."""
    partials = cut_lineage(partials, "partials")
    sums = ["n", "sz", "sy", "sx"]
    labels = connected_components(_contacts(partials, "reach").select("a", "b").distinct())
    if chunked:
        labels = _follow_chunks(partials, labels)
    inner = partials.filter("size(border) = 0").select("root", *sums)
    outer = (
        partials.filter("size(border) > 0")
        .select("root", *sums)
        .join(labels.select(F.col("node").alias("root"), F.col("root").alias("whole")), "root", "left")
        .groupBy(F.coalesce("whole", "root").alias("root"))
        .agg(*[F.sum(s).alias(s) for s in sums])
    )
    return inner.unionByName(outer)


def _follow_chunks(partials: DataFrame, labels: DataFrame) -> DataFrame:
    """Chunk-by-chunk rule: a component continues the first one met above it.

    ``labels`` joins the parts inside each chunk. Every component of the next
    chunk keeps a single contact, the one at its first voxel in raster order.
    """
    labels = cut_lineage(labels, "chunk-labels")

    def whole(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(side), F.col("root").alias(f"{side}_whole"))

    met = (
        _contacts(partials, "carry")
        .join(whole("a"), "a", "left")
        .join(whole("b"), "b", "left")
        .select(F.coalesce("a_whole", "a").alias("a"), F.coalesce("b_whole", "b").alias("b"), "voxel")
    )
    chosen = met.groupBy("b").agg(F.min_by("a", "voxel").alias("a"))
    across = connected_components(chosen.select("a", "b"))
    final = across.select(F.col("node").alias("root"), F.col("root").alias("top"))
    within = labels.join(final, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    only = across.join(labels, "node", "left_anti")
    return within.unionByName(only)


def number_in_order(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Number rows 1..n in key order without passing them through one task.

    The rows are range-partitioned and written with their partition number; only
    the row count of each partition reaches the driver.
    """
    rows = cut_lineage(rows, "numbered")
    parts = rows.count() // ROWS_PER_RANGE + 1
    ranged = cut_lineage(rows.repartitionByRange(parts, key).withColumn("_part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("_part").count().orderBy("_part").collect()
    starts, seen = [], 0
    for part, count in counts:
        starts.append((part, seen))
        seen += count
    offsets = rows.sparkSession.createDataFrame(starts, "_part int, _start bigint")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    return (
        ranged.withColumn("_row", inside)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_row") + F.col("_start"))
        .drop("_part", "_row", "_start")
    )


def components(
    volume: DataFrame,
    meta: VolumeMeta,
    connectivity: int = 18,
    merge: str = "exact",
    z_chunk: int = 100,
    brick: int | None = None,
) -> DataFrame:
    """Whole components ``(root, n, z, y, x)`` of blocks or of a voxel table.

    ``root`` is the raster index of the component's first voxel and ``z, y, x``
    the floor-division centroid. ``merge='chunked'`` follows the chunk-by-chunk
    rule instead of the true components.
    """
    if merge not in ("exact", "chunked"):
        raise ValueError(f"merge must be 'exact' or 'chunked', got {merge!r}")
    chunk = z_chunk if merge == "chunked" else None
    if "data" in volume.columns:
        partials = label_blocks(volume, meta, connectivity, chunk)
    else:
        fg = volume.filter("value > 0") if "value" in volume.columns else volume
        partials = label_voxels(fg, meta.shape, connectivity, chunk, brick)
    whole = join_partials(partials, chunked=chunk is not None)
    return whole.select("root", "n", *[F.expr(f"s{a} div n").cast("int").alias(a) for a in ("z", "y", "x")])


def detect_cells(
    volume: DataFrame,
    meta: VolumeMeta,
    biomarker: str,
    brain_id: str,
    run_id: str,
    voxel_size_um: tuple[float, float, float],
    connectivity: int = 18,
    merge: str = "exact",
    z_chunk: int = 100,
) -> DataFrame:
    """The cells table of one mask; cells start unassigned and not passed."""
    found = number_in_order(components(volume, meta, connectivity, merge, z_chunk), "root", "cell_id")
    voxel_um3 = float(voxel_size_um[0] * voxel_size_um[1] * voxel_size_um[2])
    values = {
        "volume_voxels": F.col("n"),
        "volume_um3": F.col("n").cast("double") * F.lit(voxel_um3),
        "biomarker": F.lit(biomarker),
        "region_id": F.lit(None),
        "hemisphere_id": F.lit(HEMISPHERE_NA),
        "brain_id": F.lit(brain_id),
        "run_id": F.lit(run_id),
        "passed_filter": F.lit(False),
    }
    return found.select(
        *[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in CELL_SCHEMA.fields]
    )
