"""The ``voxtally`` data source: volumes as distributed blocks or voxels."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

from voxtally.functions.coords import AXES, check_order, permute_shape
from voxtally.schema import BLOCK_SCHEMA, VOXEL_SCHEMA, Shape, VolumeMeta, voxel_schema
from voxtally.sources import nifti, png, tiff, zarr2
from voxtally.sources.layout import (
    BLOCK_TASK_BYTES,
    TASK_BYTES,
    Box,
    FileLayout,
    clip,
    grid_box,
    grid_span,
    is_empty,
    kind_of,
    volume_files,
)

log = logging.getLogger(__name__)

DESCRIBE = {"tiff": tiff.describe, "nifti": nifti.describe, "zarr": zarr2.describe}
_BLOCK_ARROW = pa.schema([(f.name, pa.binary() if f.name == "data" else pa.int32()) for f in BLOCK_SCHEMA.fields])


@dataclass(frozen=True)
class Stack:
    """Files stacked along Z, before any axis permutation."""

    files: tuple[FileLayout, ...]

    @property
    def shape(self) -> Shape:
        return (sum(f.shape[0] for f in self.files), *self.files[0].shape[1:])

    @property
    def dtype(self) -> np.dtype:
        return np.dtype(self.files[0].dtype).newbyteorder("<")

    @property
    def starts(self) -> list[int]:
        out = [0]
        for f in self.files[:-1]:
            out.append(out[-1] + f.shape[0])
        return out


def describe_stack(path: str) -> Stack:
    files, skipped = volume_files(path)
    if skipped:
        log.warning("%s: skipped %d files with another suffix", path, len(skipped))
    with ThreadPoolExecutor() as pool:
        layouts = list(pool.map(lambda f: DESCRIBE[kind_of(f)](f), files))
    if len({layout.shape[1:] for layout in layouts}) > 1:
        raise ValueError(f"{path}: files differ in XY shape")
    if len({np.dtype(layout.dtype) for layout in layouts}) > 1:
        raise ValueError(f"{path}: files differ in sample type")
    return Stack(tuple(layouts))


@dataclass(frozen=True)
class BoxRange:
    """Cells ``first..last`` of the grid of one file, inside a wanted box."""

    layout: FileLayout
    z_offset: int
    wanted: Box
    first: int
    last: int


@dataclass
class ReadTask(InputPartition):
    """Box ranges of one or more files, read by one task."""

    ranges: list[BoxRange]

    def __post_init__(self):
        super().__init__(None)


def _narrowed(layout: FileLayout, wanted: Box, first: int, last: int) -> FileLayout:
    """The layout without the page entries that a range of boxes does not need, so a task does not carry the whole table."""
    if "slots" not in layout.detail:
        return layout
    span = grid_span(layout.shape, layout.grid, wanted)
    ends = [grid_box(layout.shape, layout.grid, span, k)[0] for k in (first, last - 1)]
    return tiff.with_pages(layout, ends[0][0], ends[1][1])


def plan_tasks(stack: Stack, wanted: Box, parallel: int = 1, most: int = TASK_BYTES) -> list[ReadTask]:
    """Only files and boxes that overlap the wanted part, in evenly sized tasks.

    Large files are split between tasks and small ones share a task.
    """
    spans = []
    for layout, start in zip(stack.files, stack.starts):
        local = clip(((wanted[0][0] - start, wanted[0][1] - start), *wanted[1:]), tuple((0, s) for s in layout.shape))
        if not is_empty(local):
            cells = prod(b - a for a, b in grid_span(layout.shape, layout.grid, local))
            spans.append((layout, start, local, cells))
    total = sum(layout.box_bytes() * cells for layout, _, _, cells in spans)
    room = max(1, min(most, total // max(1, parallel)))
    tasks, filled = [], room
    for layout, start, local, cells in spans:
        step = cells if layout.sequential else max(1, room // layout.box_bytes())
        for first in range(0, cells, step):
            last = min(first + step, cells)
            size = (last - first) * layout.box_bytes()
            if filled + size > room:
                tasks.append(ReadTask([]))
                filled = 0
            tasks[-1].ranges.append(BoxRange(_narrowed(layout, local, first, last), start, local, first, last))
            filled += size
    return tasks


def read_range(part: BoxRange) -> Iterator[tuple[Box, np.ndarray]]:
    """Boxes of one range in raw stack coordinates, native byte order."""
    layout = part.layout
    span = grid_span(layout.shape, layout.grid, part.wanted)
    boxes = (clip(grid_box(layout.shape, layout.grid, span, k), part.wanted) for k in range(part.first, part.last))
    if layout.kind == "nifti":
        found = nifti.read_boxes(layout, boxes)
    else:
        read = tiff.read_box if layout.kind == "tiff" else zarr2.read_box
        found = ((box, read(layout, box)) for box in boxes)
    for (z, y, x), data in found:
        if data is not None:
            yield ((z[0] + part.z_offset, z[1] + part.z_offset), y, x), data.astype(data.dtype.newbyteorder("<"), copy=False)


def read_box(stack: Stack, order: tuple[int, int, int], box: Box) -> np.ndarray:
    """Any box of a stored volume in logical order; chunks that were never written are 0."""
    raw = [(0, 0)] * 3
    for logical, axis in enumerate(order):
        raw[axis] = box[logical]
    out = np.zeros([b - a for a, b in raw], stack.dtype)
    for task in plan_tasks(stack, tuple(raw)):
        for part in task.ranges:
            for found, data in read_range(part):
                out[tuple(slice(a - o, b - o) for (a, b), (o, _) in zip(found, raw))] = data
    return out.transpose(order)


def block_batch(box: Box, data: np.ndarray) -> pa.RecordBatch:
    row = [a for a, _ in box] + [b - a for a, b in box] + [np.ascontiguousarray(data).tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK_ARROW)], schema=_BLOCK_ARROW)


def voxel_batch(box: Box, data: np.ndarray) -> pa.RecordBatch:
    at = np.nonzero(data)
    columns = [pa.array((axis + start).astype(np.int32)) for axis, (start, _) in zip(at, box)]
    values = data[at].astype(np.float64 if data.dtype.kind == "f" else np.int64)
    return pa.RecordBatch.from_arrays([*columns, pa.array(values)], names=VOXEL_SCHEMA.names)


class VolumeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        order = options.get("order")
        self.order = check_order(order.split(",")) if order else (0, 1, 2)
        self.blocks = options.get("layout", "voxels") == "blocks"
        self.parallel = int(options.get("parallel", 1))
        self.bounds = {a: [int(options.get(f"{a}_start", 0)), int(options.get(f"{a}_end", 2**31 - 1))] for a in AXES}

    def partitions(self) -> list[InputPartition]:
        stack = describe_stack(self.path)
        raw: list = [None, None, None]
        for logical, axis in enumerate(self.order):
            lo, hi = self.bounds[AXES[logical]]
            raw[axis] = (max(0, lo), min(hi, stack.shape[axis]))
        return plan_tasks(stack, tuple(raw), self.parallel, BLOCK_TASK_BYTES if self.blocks else TASK_BYTES)

    def read(self, partition: ReadTask | None) -> Iterator[pa.RecordBatch]:
        pack = block_batch if self.blocks else voxel_batch
        for part in getattr(partition, "ranges", []):  # None when nothing overlaps the wanted box
            for box, data in read_range(part):
                yield pack(tuple(box[a] for a in self.order), data.transpose(self.order))


class FilteringReader(VolumeReader):
    """Reader for sessions with ``spark.sql.python.filterPushdown.enabled``; Spark rejects the hook in others."""

    def pushFilters(self, filters: list[Filter]):
        """Narrow the box by comparisons on z, y and x; Spark re-checks every row."""
        for f in filters:
            axis = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if not self.blocks and axis in AXES and isinstance(getattr(f, "value", None), int):
                lo, hi = self.bounds[axis]
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    lo = max(lo, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    hi = min(hi, f.value + (not isinstance(f, LessThan)))
                self.bounds[axis] = [lo, hi]
            yield f


class VolumeSource(DataSource):
    """``spark.read.format('voxtally')``.

    Options: path, order (as ``1,0,2``), layout (voxels or blocks), z/y/x_start and
    _end, parallel (least number of tasks), pushdown (true to narrow by filters),
    dtype (sample type, if it is known already).
    """

    @classmethod
    def name(cls) -> str:
        return "voxtally"

    def schema(self) -> StructType:
        if self.options.get("layout", "voxels") == "blocks":
            return BLOCK_SCHEMA
        kind = self.options.get("dtype") or describe_stack(self.options["path"]).dtype.name
        return voxel_schema(kind)

    def reader(self, schema: StructType) -> DataSourceReader:
        options = dict(self.options)
        return FilteringReader(options) if options.get("pushdown") == "true" else VolumeReader(options)


@dataclass(frozen=True)
class Volume:
    """A stored volume in logical (Z, Y, X) order; voxels stay on the executors."""

    spark: SparkSession
    path: str
    meta: VolumeMeta
    order: tuple[int, int, int] | None = None

    def _load(self, layout: str, lo: Shape | None, hi: Shape | None) -> DataFrame:
        if kind_of(volume_files(self.path)[0][0]) == "image":
            return _image_rows(self, layout, lo, hi)
        reader = self.spark.read.format("voxtally").option("path", self.path).option("layout", layout).option("dtype", self.meta.dtype)
        reader = reader.option("parallel", self.spark.sparkContext.defaultParallelism)
        reader = reader.option("pushdown", self.spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
        if self.order:
            reader = reader.option("order", ",".join(map(str, self.order)))
        for axis, a, b in zip(AXES, lo or (0, 0, 0), hi or self.meta.shape):
            reader = reader.option(f"{axis}_start", a).option(f"{axis}_end", b)
        return reader.load()

    def blocks(self, lo: Shape | None = None, hi: Shape | None = None) -> DataFrame:
        """Dense boxes inside a half-open sub-volume, in whole-volume coordinates."""
        return self._load("blocks", lo, hi)

    def voxels(self, lo: Shape | None = None, hi: Shape | None = None) -> DataFrame:
        """Non-zero voxels inside a half-open sub-volume, in whole-volume coordinates."""
        return self._load("voxels", lo, hi)


    def box_reader(self) -> Callable[[Box], np.ndarray] | None:
        """Reads any box inside a task; None for images and for files that can only be read from their start."""
        if kind_of(volume_files(self.path)[0][0]) == "image":
            return None
        stack, order = describe_stack(self.path), self.order or (0, 1, 2)
        if any(f.sequential for f in stack.files):
            return None
        return lambda box: read_box(stack, order, box)

    def grid(self) -> Shape:
        """Size of the boxes in which the first file is stored, in logical order."""
        return permute_shape(describe_stack(self.path).files[0].grid, self.order or (0, 1, 2))


def open_volume(spark: SparkSession, path: str, order=None) -> Volume:
    """Read shape and sample type of a file, a folder stacked along Z, or a Zarr store."""
    path = str(path)
    spark.dataSource.register(VolumeSource)
    axes = check_order(order) if order is not None else None
    if kind_of(volume_files(path)[0][0]) == "image":
        shape, dtype = _image_shape(spark, path)
    else:
        stack = describe_stack(path)
        shape, dtype = stack.shape, stack.dtype.name
    return Volume(spark, path, VolumeMeta(permute_shape(shape, axes) if axes else shape, dtype), axes)


# Plain images go through Spark's own image source, which decodes in the JVM to 8 bits; grey PNG files of 16 bits are decoded here.


def _ordered(spark: SparkSession, path: str) -> DataFrame:
    """Each file with its place, under the name that Spark's sources give it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = volume_files(path)[0]
    return spark.createDataFrame([(hadoop(f).toUri().getRawPath(), k) for k, f in enumerate(files)], "file string, k int")


def _deep(spark: SparkSession, path: str) -> bool:
    """Whether the images are PNG with 16 bits a sample."""
    files = volume_files(path)[0]
    if not files[0].lower().endswith(".png"):
        return False
    head = spark.read.format("binaryFile").load(files).select(F.hex(F.substring("content", 25, 1)).alias("bits"))
    bits = {r.bits for r in head.distinct().collect()}
    if "10" in bits and len(bits) > 1:
        raise ValueError(f"{path}: images differ in depth")
    return "10" in bits


def _images(spark: SparkSession, path: str) -> DataFrame:
    """Rows of place, size and samples; every file has to be there."""
    files, order = volume_files(path)[0], _ordered(spark, path)
    if _deep(spark, path):
        rows = spark.read.format("binaryFile").load(files).select("path", "content").mapInArrow(png.decode_batches, png.IMAGE_DDL)
        names = order.withColumn("file", F.expr("url_decode(replace(file, '+', '%2B'))"))
        found = rows.withColumn("file", F.regexp_replace("path", "^file:/+", "/")).join(names, "file", "right")
    else:
        rows = spark.read.format("image").load(files).select("image.*")
        found = rows.withColumn("file", F.expr("parse_url(origin, 'PATH')")).join(order, "file", "right")
    missing = F.when(F.col("data").isNull(), F.raise_error(F.concat(F.lit("image cannot be read: "), F.col("file"))))
    return found.withColumn("data", F.coalesce(missing.cast("binary"), F.col("data")))


def _image_shape(spark: SparkSession, path: str) -> tuple[Shape, str]:
    sizes = _images(spark, path).groupBy("height", "width", "nChannels", (F.length("data") > F.col("height") * F.col("width") * F.col("nChannels")).alias("deep")).count().take(2)
    if len(sizes) != 1:
        raise ValueError(f"{path}: images differ in XY shape")
    h, w, c, deep, n = sizes[0]
    return (n, h, w) if c == 1 else (n * h, w, c), "uint16" if deep else "uint8"


def _image_rows(volume: Volume, layout: str, lo: Shape | None, hi: Shape | None) -> DataFrame:
    """A grey image is one slice; a colour image is an (Y, X, channel) box."""
    order, kind = volume.order or (0, 1, 2), np.dtype(volume.meta.dtype)
    wanted = tuple(zip(lo or (0, 0, 0), hi or volume.meta.shape))
    pack = block_batch if layout == "blocks" else voxel_batch

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                h, w, c = r["height"], r["width"], r["nChannels"]
                data = np.frombuffer(r["data"], kind).reshape(h, w, c)
                data = data.transpose(2, 0, 1) if c == 1 else data[:, :, [2, 1, 0, 3][:c]]
                z = r["k"] * data.shape[0]
                data = data.transpose(order)
                start = [(z, 0, 0)[a] for a in order]
                box = clip(tuple((s, s + n) for s, n in zip(start, data.shape)), wanted)
                if not is_empty(box):
                    yield pack(box, data[tuple(slice(a - s, b - s) for (a, b), s in zip(box, start))])

    schema = BLOCK_SCHEMA if layout == "blocks" else VOXEL_SCHEMA
    return _images(volume.spark, volume.path).select("k", "height", "width", "nChannels", "data").mapInArrow(read, schema)
