"""Volume sinks: every task writes its own boxes straight to their place.

Raster formats (TIFF, NIfTI) have a fixed layout, so a file is laid out first
and its rows are then filled in by many tasks; Zarr gets one file per chunk.
Nothing is gathered: a task holds one box of bounded size. Results appear under
their final name only when whole, and a repeated task writes the same bytes.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxtally.functions.boxes import block_rows
from voxtally.functions.coords import permute, permute_shape
from voxtally.operators.volume import crop, pyramid_shapes, resample, resized_box
from voxtally.schema import Shape, VolumeMeta
from voxtally.session import cut_lineage
from voxtally.sources import nifti, tiff, zarr2
from voxtally.sources.layout import TASK_BYTES, Box, raster_grid
from voxtally.sources.reader import Volume, open_volume

# Name suffix of each output type (fixed values).
SUFFIXES = {
    "zarr": ".zarr",
    "ome-zarr": ".ome.zarr",
    "single-tiff": ".tiff",
    "scroll-tiff": ".scroll-tif",
    "single-nii": ".nii.gz",
    "scroll-nii": ".scroll-nii",
}
# Label of each output type in user interfaces (fixed values).
TYPE_LABELS = {
    "OME-Zarr": "ome-zarr",
    "Zarr": "zarr",
    "Tif": "single-tiff",
    "Nifti": "single-nii",
    "Scroll-Tif": "scroll-tiff",
    "Scroll-Nifti": "scroll-nii",
}
CHUNK = (128, 128, 128)
_KEYS = ["_pz", "_py", "_px"]
_DONE_DDL = "z0 int, y0 int, x0 int, bytes bigint"

Sink = Callable[[Box, np.ndarray], int]


def expected_output_path(folder: str, name: str, output_type: str) -> str:
    if output_type not in SUFFIXES:
        raise ValueError(f"unknown output type {output_type!r}")
    return os.path.join(folder, name + SUFFIXES[output_type])


def slice_name(z: int, suffix: str) -> str:
    return f"slice_{z:05d}{suffix}"


@dataclass(frozen=True)
class Made:
    """A volume given by a function that makes any box of it inside a task."""

    spark: SparkSession
    make: Callable[[Box], np.ndarray]


def made_from(source: Volume, target: Shape | None = None, order: int = 0, permutation=None, change: Callable | None = None) -> Made | None:
    """A stored volume resized to ``target``, its axes permuted, its values changed; None if it has no random access.

    ``target`` is the shape before the permutation, ``change`` runs on source boxes.
    """
    read = source.box_reader()
    if read is None:
        return None
    shape, turn = source.meta.shape, permutation or (0, 1, 2)
    changed = read if change is None else lambda box: change(read(box))

    def make(box: Box) -> np.ndarray:
        straight = [(0, 0)] * 3
        for logical, axis in enumerate(turn):
            straight[axis] = box[logical]
        straight = tuple(straight)
        data = changed(straight) if target in (None, shape) else resized_box(changed, shape, target, straight, order)
        return data.transpose(turn)

    return Made(source.spark, make)


@dataclass(frozen=True)
class ZarrSink:
    """One file a chunk; with ``slab`` only the Z range that is written changes in a chunk that is there."""

    path: str
    grid: Shape
    codec: str = "zlib"
    slab: tuple[int, int] | None = None

    def __call__(self, box: Box, data: np.ndarray) -> int:
        chunk = np.zeros(self.grid, data.dtype)
        final = os.path.join(self.path, ".".join(str(a // g) for (a, _), g in zip(box, self.grid)))
        inner, rows = tuple(slice(0, n) for n in data.shape), slice(None)
        if self.slab:
            rows = slice(*(min(max(z - box[0][0], 0), len(data)) for z in self.slab))
            if os.path.exists(final):
                with open(final, "rb") as f:
                    kind = "blosc" if self.codec != "zlib" else "zlib"
                    chunk = np.frombuffer(zarr2.decode(f.read(), kind), data.dtype).reshape(self.grid).copy()
            elif not data[rows].any():
                return 0
        elif not data.any():
            return 0
        chunk[inner][rows] = data[rows]
        raw = zarr2.encode(chunk, self.codec)
        temp = f"{final}.{uuid.uuid4().hex[:8]}"
        with open(temp, "wb") as f:
            f.write(raw)
        os.replace(temp, final)
        return len(raw)


@dataclass(frozen=True)
class RasterSink:
    """Rows at their offset in one file, or in the file of their slice."""

    path: str
    shape: Shape
    offset: int
    sliced: bool
    slab: tuple[int, int] | None = None

    def __call__(self, box: Box, data: np.ndarray) -> int:
        (z0, _), (y0, _), _ = box
        _, height, width = self.shape
        first, end = self.slab or (0, self.shape[0])
        for k, plane in enumerate(data):
            if not first <= z0 + k < end:
                continue
            path = os.path.join(self.path, slice_name(z0 + k, ".tiff")) if self.sliced else self.path
            row = (0 if self.sliced else (z0 + k) * height) + y0
            out = os.open(path, os.O_WRONLY)
            try:
                os.pwrite(out, plane.tobytes(), self.offset + row * width * data.itemsize)
            finally:
                os.close(out)
        return data.nbytes


@dataclass(frozen=True)
class GzipPartSink:
    """One gzip member per box; members joined in raster order are one stream."""

    folder: str

    def __call__(self, box: Box, data: np.ndarray) -> int:
        raw = nifti.gzip_member(data.tobytes())
        final = part_path(self.folder, box[0][0], box[1][0])
        temp = f"{final}.{uuid.uuid4().hex[:8]}"
        with open(temp, "wb") as f:
            f.write(raw)
        os.replace(temp, final)
        return len(raw)


def part_path(folder: str, z: int, y: int) -> str:
    return os.path.join(folder, f"part-{z}-{y}")


def _grid_keys(grid: Shape, columns) -> list:
    return [F.expr(f"cast({c} div {g} as int)").alias(k) for k, c, g in zip(_KEYS, columns, grid)]


def _every_cell(spark, shape: Shape, grid: Shape) -> DataFrame:
    """One row per grid cell, for formats that need their empty boxes too."""
    nz, ny, nx = (-(-s // g) for s, g in zip(shape, grid))
    return spark.range(nz * ny * nx).selectExpr(
        f"cast(id div {ny * nx} as int) as _pz", f"cast(id div {nx} % {ny} as int) as _py", f"cast(id % {nx} as int) as _px"
    )


def _fragments(blocks: DataFrame, grid: Shape, dtype: np.dtype) -> DataFrame:
    """Cut blocks where they cross the target grid."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in block_rows(batch):
                start, size = (r["z0"], r["y0"], r["x0"]), (r["dz"], r["dy"], r["dx"])
                data = np.frombuffer(r["data"], dtype).reshape(size)
                spans = [range(s // g, -(-(s + n) // g)) for s, n, g in zip(start, size, grid)]
                for pz in spans[0]:
                    for py in spans[1]:
                        for px in spans[2]:
                            lo = [max(s, p * g) for s, p, g in zip(start, (pz, py, px), grid)]
                            hi = [min(s + n, (p + 1) * g) for s, n, p, g in zip(start, size, (pz, py, px), grid)]
                            part = data[tuple(slice(a - s, b - s) for a, b, s in zip(lo, hi, start))]
                            row = [pz, py, px, *lo, *part.shape]
                            arrays = [pa.array([v], pa.int32()) for v in row] + [pa.array([part.tobytes()], pa.binary())]
                            yield pa.RecordBatch.from_arrays(arrays, names=[*_KEYS, "z0", "y0", "x0", "dz", "dy", "dx", "data"])

    names = "_pz int, _py int, _px int, z0 int, y0 int, x0 int, dz int, dy int, dx int, data binary"
    return blocks.mapInArrow(cut, names)


def _checked(values: np.ndarray, dtype: np.dtype) -> np.ndarray:
    """Values in the sample type of the volume; what it cannot hold is an error."""
    if dtype.kind in "iu" and values.size:
        limits = np.iinfo(dtype)
        if values.min() < limits.min or values.max() > limits.max or (values.dtype.kind == "f" and (values != np.trunc(values)).any()):
            raise ValueError(f"values from {values.min()} to {values.max()} do not fit {dtype}")
    return values.astype(dtype)


def _make_all(volume: Made, meta: VolumeMeta, grid: Shape, sink: Sink, slab: tuple[int, int] | None = None) -> DataFrame:
    """One task row for every grid cell: make the box and hand it to the sink. Nothing is shuffled."""
    dtype, shape, make = np.dtype(meta.dtype), meta.shape, volume.make
    counts = [-(-s // g) for s, g in zip(shape, grid)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column(0).to_pylist():
                at = (cell // (counts[1] * counts[2]), cell // counts[2] % counts[1], cell % counts[2])
                box = tuple((c * g, min(c * g + g, n)) for c, g, n in zip(at, grid, shape))
                if slab and (box[0][1] <= slab[0] or box[0][0] >= slab[1]):
                    continue
                data = np.ascontiguousarray(_checked(make(box), dtype))
                row = [a for a, _ in box] + [sink(box, data)]
                types = [pa.int32()] * 3 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=["z0", "y0", "x0", "bytes"])

    cells = counts[0] * counts[1] * counts[2]
    parts = max(1, min(cells, 4 * volume.spark.sparkContext.defaultParallelism, cells * grid[0] * grid[1] * grid[2] * dtype.itemsize // TASK_BYTES + volume.spark.sparkContext.defaultParallelism))
    return volume.spark.range(0, cells, 1, parts).mapInArrow(run, _DONE_DDL)


def _store(volume: DataFrame | Made, meta: VolumeMeta, grid: Shape, sink: Sink, every: bool = False, slab: tuple[int, int] | None = None) -> DataFrame:
    """Assemble each grid cell in one task and hand it to the sink.

    A group is one grid cell, so its size is bounded by the grid, not the data.
    """
    if isinstance(volume, Made):
        return _make_all(volume, meta, grid, sink, slab)
    dtype, shape = np.dtype(meta.dtype), meta.shape
    dense = "data" in volume.columns
    if dense:
        pieces = _fragments(volume, grid, dtype)
    else:
        pieces = volume.select(*_grid_keys(grid, "zyx"), "z", "y", "x", "value")
    if every:
        cells = _every_cell(volume.sparkSession, shape, grid)
        if slab:
            cells = cells.filter((F.col("_pz") * grid[0] < slab[1]) & ((F.col("_pz") + 1) * grid[0] > slab[0]))
        pieces = pieces.unionByName(cells, allowMissingColumns=True)

    def put(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = tuple(k.as_py() * g for k, g in zip(key, grid))
        box = tuple((s, min(s + g, n)) for s, g, n in zip(start, grid, shape))
        if any(a < 0 or b <= a for a, b in box):
            raise ValueError(f"voxels near {start} are outside the volume {shape}")
        out = np.zeros([b - a for a, b in box], dtype)
        for batch in batches:
            if dense:
                for r in block_rows(batch):
                    if r["data"] is not None:
                        size = (r["dz"], r["dy"], r["dx"])
                        at = tuple(slice(r[c] - s, r[c] - s + n) for c, s, n in zip(("z0", "y0", "x0"), start, size))
                        out[at] = np.frombuffer(r["data"], dtype).reshape(size)
            else:
                batch = batch.filter(batch.column("z").is_valid())
                at = tuple(batch.column(c).to_numpy() - s for c, s in zip("zyx", start))
                if any(a.size and (a.min() < 0 or a.max() >= n) for a, n in zip(at, out.shape)):
                    raise ValueError(f"voxels near {start} are outside the volume {shape}")
                out[at] = _checked(batch.column("value").to_numpy(), dtype)
        row = [*start, sink(box, out)]
        names = ["z0", "y0", "x0", "bytes"]
        types = [pa.int32()] * 3 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    return pieces.groupBy(*_KEYS).applyInArrow(put, _DONE_DDL)


def _each_slice(spark, first: int, end: int, work: Callable[[int], None]) -> None:
    """Run a small file task for every Z index, spread over the cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for z in batch.column(0).to_pylist():
                work(z)
            yield batch

    spark.range(first, end).mapInArrow(run, "id bigint").count()


def _write_zarr(volume: DataFrame | Made, meta: VolumeMeta, path: str, chunk: Shape, codec: str = "zlib", slab: tuple[int, int] | None = None) -> None:
    grid = tuple(max(1, min(c, s)) for c, s in zip(chunk, meta.shape))
    os.makedirs(path, exist_ok=slab is not None)
    head, final = zarr2.metadata(meta.shape, grid, meta.dtype, codec), os.path.join(path, ".zarray")
    if slab and os.path.exists(final):
        with open(final) as f:
            unlike = zarr2.differences(json.load(f), json.loads(head))
        if unlike:
            raise ValueError(f"{path}: the store that is there has another {', '.join(unlike)}")
    else:
        temp = f"{final}.{uuid.uuid4().hex[:8]}"
        with open(temp, "w") as f:
            f.write(head)
        os.replace(temp, final)
    _store(volume, meta, grid, ZarrSink(path, grid, codec, slab), every=slab is not None, slab=slab).count()


def _write_ome(volume: DataFrame | Made, meta: VolumeMeta, path: str, chunk: Shape, levels: int, factor: int, order: int, codec: str) -> None:
    """Each level is resampled from the stored level before it."""
    spark = _session(volume)
    os.makedirs(path)
    with open(os.path.join(path, ".zgroup"), "w") as f:
        f.write('{"zarr_format": 2}')
    shapes = pyramid_shapes(meta.shape, levels, factor)
    current = volume
    for k, shape in enumerate(shapes):
        if k:
            previous = open_volume(spark, f"{path}/{k - 1}/")
            current = made_from(previous, shape, order)
        _write_zarr(current, VolumeMeta(shape, meta.dtype), os.path.join(path, str(k)), chunk, codec)
    with open(os.path.join(path, ".zattrs"), "w") as f:
        f.write(zarr2.multiscales(levels, factor))


def _session(volume: DataFrame | Made) -> SparkSession:
    return volume.spark if isinstance(volume, Made) else volume.sparkSession


def _write_tiff(volume: DataFrame | Made, meta: VolumeMeta, path: str, sliced: bool, slab: tuple[int, int] | None = None) -> None:
    z, y, x = meta.shape
    head, offset = tiff.header((1, y, x) if sliced else meta.shape, meta.dtype)
    size = offset + (1 if sliced else z) * y * x * np.dtype(meta.dtype).itemsize

    def lay_out(target: str) -> None:
        with open(target, "wb") as f:
            f.write(head)
            f.truncate(size)

    if sliced:
        os.makedirs(path, exist_ok=slab is not None)
        first, end = slab or (0, z)
        for there in [f for f in sorted(os.listdir(path)) if f.endswith(".tiff")][:1]:
            layout = tiff.describe(os.path.join(path, there))
            if (*layout.shape[1:], np.dtype(layout.dtype)) != (y, x, np.dtype(meta.dtype)):
                raise ValueError(f"{path}: the slices that are there have another shape or sample type")
        _each_slice(_session(volume), first, end, lambda k: lay_out(os.path.join(path, slice_name(k, ".tiff"))))
    else:
        lay_out(path)
    grid = raster_grid(meta.shape, np.dtype(meta.dtype).itemsize)
    _store(volume, meta, grid, RasterSink(path, meta.shape, offset, sliced, slab), slab=slab).count()


def _offsets(done: DataFrame, depth: int, sliced: bool, head: int) -> DataFrame:
    """Byte position of every part: a running sum of the sizes before it.

    For one large file the sum runs inside at most 1000 Z groups at once, on
    top of the running sum of the group sizes.
    """

    def before(order):
        return F.coalesce(F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    if sliced:
        return done.select("z0", "y0", (before(Window.partitionBy("z0").orderBy("y0")) + head).alias("at"))
    grouped = done.withColumn("_g", F.expr(f"cast(z0 div {-(-depth // 1000)} as int)"))
    starts = grouped.groupBy("_g").agg(F.sum("bytes").alias("bytes"))
    starts = starts.select("_g", before(Window.orderBy("_g")).alias("_start"))
    inside = before(Window.partitionBy("_g").orderBy("z0", "y0"))
    return grouped.withColumn("_in", inside).join(F.broadcast(starts), "_g").select("z0", "y0", (F.col("_in") + F.col("_start") + head).alias("at"))


def _write_nifti(volume: DataFrame | Made, meta: VolumeMeta, path: str, sliced: bool) -> None:
    z, y, x = meta.shape
    spark = _session(volume)
    head = nifti.gzip_member(nifti.header((1, y, x) if sliced else meta.shape, meta.dtype))
    parts = f"{path}.parts"
    os.makedirs(parts)
    depth, rows, width = raster_grid(meta.shape, np.dtype(meta.dtype).itemsize)
    grid = (1 if sliced else depth, rows, width)
    done = cut_lineage(_store(volume, meta, grid, GzipPartSink(parts), every=True), "parts")
    placed = _offsets(done, z, sliced, len(head))

    def name(k: int) -> str:
        return os.path.join(path, slice_name(k, ".nii.gz")) if sliced else path

    def lay_out(target: str) -> None:
        with open(target, "wb") as f:
            f.write(head)

    if sliced:
        os.makedirs(path)
        _each_slice(spark, 0, z, lambda k: lay_out(name(k)))
    else:
        lay_out(path)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with open(part_path(parts, r["z0"], r["y0"]), "rb") as f:
                    raw = f.read()
                out = os.open(name(r["z0"]), os.O_WRONLY)
                try:
                    os.pwrite(out, raw, r["at"])
                finally:
                    os.close(out)
            yield batch.select(["at"])

    placed.mapInArrow(place, "at bigint").count()
    shutil.rmtree(parts)


def replace_output(temp: str, final: str) -> None:
    if os.path.isdir(final):
        shutil.rmtree(final)
    os.replace(temp, final)


def _slices(volume: DataFrame | Made, meta: VolumeMeta, first: int, end: int) -> DataFrame | Made:
    """The slices of a Z range as a volume of their own."""
    if isinstance(volume, Made):
        make = volume.make
        return Made(volume.spark, lambda box: make(((box[0][0] + first, box[0][1] + first), *box[1:])))
    if "data" not in volume.columns:
        return crop(volume, (first, 0, 0), (end, *meta.shape[1:]))
    low, high = F.greatest("z0", F.lit(first)), F.least(F.col("z0") + F.col("dz"), F.lit(end))
    plane = F.col("dy") * F.col("dx") * np.dtype(meta.dtype).itemsize
    rows = F.substring("data", (low - F.col("z0")) * plane + 1, (high - low) * plane)
    return volume.filter(low < high).withColumns({"z0": low - first, "dz": high - low, "data": rows})


# Types that a part can be written into, one slab after the other.
SLAB_TYPES = ("zarr", "scroll-tiff")


def _write_slab(volume: DataFrame | Made, meta: VolumeMeta, path: str, output_type: str, chunk: Shape, codec: str, slab: tuple[int, int]) -> str:
    """Write the slices of a Z range into a store of the full shape; what other slices hold stays.

    All slices of the range are replaced. A store that is there must have the same
    shape, sample type, chunks and codec.
    """
    if not 0 <= slab[0] < slab[1] <= meta.shape[0]:
        raise ValueError(f"slices {slab[0]} to {slab[1]} are not in a volume of {meta.shape[0]}")
    if not isinstance(volume, Made):
        axis = "z0" if "data" in volume.columns else "z"
        reach = F.col("z0") + F.col("dz") if axis == "z0" else F.col("z") + 1
        volume = volume.filter((F.col(axis) < slab[1]) & (reach > slab[0]))
    if output_type == "zarr":
        _write_zarr(volume, meta, path, chunk, codec, slab)
    else:
        _write_tiff(volume, meta, path, True, slab)
    return path


def write_volume(
    volume: DataFrame | Made,
    meta: VolumeMeta,
    folder: str,
    name: str,
    output_type: str,
    chunk: Shape = CHUNK,
    levels: int = 5,
    factor: int = 2,
    resize_order: int = 0,
    z_range: tuple[int, int] | None = None,
    codec: str = "zlib",
) -> str:
    """Write blocks, voxels or a :class:`Made` volume as one of the output types; returns the path.

    ``z_range`` writes that part only: into a store of the full shape for Zarr
    and slice-wise TIFF, where slabs written one after the other add up and one
    written again replaces all its slices, and as a volume of its own, with the
    range in its name, for the other types.
    A voxel outside the volume, or a value the sample type cannot hold, is an error.
    """
    output_type = TYPE_LABELS.get(output_type, output_type)
    final = expected_output_path(str(folder), name, output_type)
    os.makedirs(folder, exist_ok=True)
    if z_range is not None and output_type in SLAB_TYPES:
        return _write_slab(volume, meta, final, output_type, chunk, codec, z_range)
    if z_range is not None:
        a, b = z_range
        volume = _slices(volume, meta, a, b)
        meta = VolumeMeta((b - a, *meta.shape[1:]), meta.dtype)
        final = expected_output_path(str(folder), f"{name}_z{a}-{b}", output_type)
    temp = os.path.join(folder, f".tmp-{uuid.uuid4().hex[:8]}-{os.path.basename(final)}")
    try:
        if output_type == "zarr":
            _write_zarr(volume, meta, temp, chunk, codec)
        elif output_type == "ome-zarr":
            _write_ome(volume, meta, temp, chunk, levels, factor, resize_order, codec)
        elif output_type.endswith("tiff"):
            _write_tiff(volume, meta, temp, output_type.startswith("scroll"))
        else:
            _write_nifti(volume, meta, temp, output_type.startswith("scroll"))
        replace_output(temp, final)
    except BaseException:
        for left in (temp, f"{temp}.parts"):
            if os.path.isdir(left):
                shutil.rmtree(left, ignore_errors=True)
            elif os.path.exists(left):
                os.unlink(left)
        raise
    return final


def convert_volume(source: Volume, folder: str, name: str, output_type: str, chunk: Shape = CHUNK) -> str:
    """Copy a stored volume into another format: each target box reads its source box, nothing is shuffled."""
    return write_volume(made_from(source) or source.blocks(), source.meta, folder, name, output_type, chunk)


def write_resized(source: Volume, target: Shape, folder: str, name: str, output_type: str, order: int = 0, permutation=None, change: Callable | None = None, dtype: str | None = None) -> str:
    """Resize a stored volume, change its values before and permute its axes after; see :func:`made_from`.

    A source without random access goes through voxel rows; it takes no ``change``.
    """
    turn = permutation or (0, 1, 2)
    meta = VolumeMeta(permute_shape(target, turn), dtype or source.meta.dtype)
    volume = made_from(source, target, order, turn, change)
    if volume is None:
        if change is not None:
            raise ValueError(f"{source.path}: convert it to a format with random access first")
        volume = permute(resample(source.voxels(), source.meta.shape, target, order), turn)
    return write_volume(volume, meta, folder, name, output_type)
