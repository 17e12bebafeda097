"""Volume formats: round trips, pushdown, permutation and hand-made files."""

import gzip
import json
import os
import struct
import zlib

import numpy as np
import pytest

from voxtally.schema import VolumeMeta
from voxtally.sources import layout
from voxtally.sources.reader import FilteringReader, open_volume
from voxtally.sources.writer import convert_volume, expected_output_path, write_volume


def to_voxels(spark, array):
    rows = [(*map(int, p), int(array[tuple(p)])) for p in np.argwhere(array)]
    return spark.createDataFrame(rows, "z int, y int, x int, value bigint")


def from_voxels(df, shape, dtype="int64"):
    out = np.zeros(shape, dtype)
    for r in df.collect():
        out[r.z, r.y, r.x] = r.value
    return out


def from_blocks(df, meta):
    out = np.zeros(meta.shape, meta.dtype)
    for r in df.collect():
        size = (r.dz, r.dy, r.dx)
        at = tuple(slice(a, a + n) for a, n in zip((r.z0, r.y0, r.x0), size))
        out[at] = np.frombuffer(r.data, meta.dtype).reshape(size)
    return out


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(layout, "BLOCK_BYTES", 600)


@pytest.mark.parametrize("kind", ["zarr", "single-tiff", "scroll-tiff", "single-nii", "scroll-nii", "ome-zarr"])
@pytest.mark.parametrize("dtype", ["uint8", "uint16"])
def test_round_trip(spark, tmp_path, kind, dtype):
    if dtype == "uint8" and kind in ("scroll-nii", "ome-zarr"):
        pytest.skip("one sample type is enough for the slow sinks")
    rng = np.random.default_rng(3)
    array = (rng.integers(0, 200, (5, 9, 40)) * (rng.random((5, 9, 40)) < 0.3)).astype(dtype)
    array[2] = 0
    meta = VolumeMeta(array.shape, dtype)
    path = write_volume(to_voxels(spark, array), meta, str(tmp_path), "v", kind, chunk=(2, 4, 16), levels=2)
    assert path == expected_output_path(str(tmp_path), "v", kind)
    assert sorted(os.listdir(tmp_path)) == [os.path.basename(path)]
    volume = open_volume(spark, path)
    assert volume.meta == meta
    np.testing.assert_array_equal(from_voxels(volume.voxels(), meta.shape), array)
    np.testing.assert_array_equal(from_blocks(volume.blocks(), meta), array)


def test_convert_and_permute(spark, tmp_path):
    array = np.arange(24, dtype="uint32").reshape(2, 3, 4)
    path = write_volume(to_voxels(spark, array), VolumeMeta(array.shape, "uint32"), str(tmp_path), "a", "zarr", chunk=(1, 2, 3))
    turned = open_volume(spark, path, (2, 0, 1))
    assert turned.meta.shape == (4, 2, 3)
    np.testing.assert_array_equal(from_voxels(turned.voxels(), (4, 2, 3)), array.transpose(2, 0, 1))
    tiff = convert_volume(turned, str(tmp_path), "b", "single-tiff")
    np.testing.assert_array_equal(from_blocks(open_volume(spark, tiff).blocks(), turned.meta), array.transpose(2, 0, 1))
    part = turned.voxels((1, 0, 1), (3, 2, 3))
    want = np.zeros((4, 2, 3), int)
    want[1:3, 0:2, 1:3] = array.transpose(2, 0, 1)[1:3, 0:2, 1:3]
    np.testing.assert_array_equal(from_voxels(part, (4, 2, 3)), want)
    assert turned.voxels((2, 0, 0), (2, 2, 3)).count() == 0


def test_comparisons_prune_boxes(spark, tmp_path):
    array = np.ones((8, 6, 6), "uint8")
    path = write_volume(to_voxels(spark, array), VolumeMeta(array.shape, "uint8"), str(tmp_path), "a", "zarr", chunk=(2, 6, 6))
    volume = open_volume(spark, path)
    assert volume.voxels().filter("z >= 3 and z < 5 and x = 2").count() == 12
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    try:
        assert open_volume(spark, path).voxels().filter("z >= 3 and z < 5 and x = 2").count() == 12
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

    reader = FilteringReader({"path": path})
    rest = list(reader.pushFilters([GreaterThanOrEqual(("z",), 3), LessThan(("z",), 5), EqualTo(("x",), 2)]))
    assert len(rest) == 3
    cells = sum(r.last - r.first for task in reader.partitions() for r in task.ranges)
    assert cells == 2


def test_tasks_split_large_and_group_small_files():
    from voxtally.sources.reader import Stack, plan_tasks

    whole = tuple((0, n) for n in (40, 8, 8))
    big = Stack((layout.FileLayout("a", "tiff", (40, 8, 8), "|u1", (1, 8, 8)),))
    assert len(plan_tasks(big, whole, 8)) == 8
    small = Stack(tuple(layout.FileLayout(str(k), "tiff", (1, 8, 8), "|u1", (1, 8, 8)) for k in range(40)))
    tasks = plan_tasks(small, whole, 4)
    assert [len(t.ranges) for t in tasks] == [10] * 4
    assert [r.z_offset for t in tasks for r in t.ranges] == list(range(40))
    assert len(plan_tasks(small, ((5, 7), *whole[1:]), 4)) == 2


def test_folder_stacks_by_name(spark, tmp_path):
    rng = np.random.default_rng(0)
    array = rng.integers(0, 9, (4, 5, 6)).astype("uint8")
    folder = tmp_path / "stack"
    for k, part in enumerate((array[:3], array[3:])):
        write_volume(to_voxels(spark, part), VolumeMeta(part.shape, "uint8"), str(folder), f"p{k}", "single-tiff")
    (folder / "z.nii").write_bytes(b"skipped")
    (folder / "notes.txt").write_text("skipped")
    volume = open_volume(spark, folder)
    assert volume.meta.shape == (4, 5, 6)
    np.testing.assert_array_equal(from_voxels(volume.voxels(), (4, 5, 6)), array)
    bad = np.ones((1, 5, 7), "uint8")
    write_volume(to_voxels(spark, bad), VolumeMeta(bad.shape, "uint8"), str(folder), "p9", "single-tiff")
    with pytest.raises(ValueError, match="XY"):
        open_volume(spark, folder)


def test_hand_made_tiff(spark, tmp_path):
    """Big-endian, deflated strips with a predictor and three interleaved samples."""
    y, x, s = 4, 5, 3
    image = np.random.default_rng(1).integers(0, 255, (y, x, s)).astype(">u2")
    delta = image.copy()
    delta[:, 1:] = image[:, 1:] - image[:, :-1]
    strips = [zlib.compress(delta[k : k + 3].tobytes()) for k in (0, 3)]
    body, offsets = b"", []
    for strip in strips:
        offsets.append(8 + len(body))
        body += strip
    at = 8 + len(body)
    arrays = struct.pack(">3H", 16, 16, 16) + struct.pack(">2I", *offsets) + struct.pack(">2I", *map(len, strips))
    tags = [
        (256, 3, 1, x << 16), (257, 3, 1, y << 16), (258, 3, 3, at), (259, 3, 1, 8 << 16), (262, 3, 1, 2 << 16),
        (273, 4, 2, at + 6), (277, 3, 1, s << 16), (278, 3, 1, 3 << 16), (279, 4, 2, at + 14), (284, 3, 1, 1 << 16),
        (317, 3, 1, 2 << 16), (339, 3, 1, 1 << 16),
    ]
    ifd = struct.pack(">H", len(tags)) + b"".join(struct.pack(">HHII", *t) for t in tags) + struct.pack(">I", 0)
    path = tmp_path / "rgb.tif"
    path.write_bytes(struct.pack(">2sHI", b"MM", 42, at + len(arrays)) + body + arrays + ifd)
    volume = open_volume(spark, path)
    assert volume.meta == VolumeMeta((3, y, x), "uint16")
    np.testing.assert_array_equal(from_voxels(volume.voxels(), (3, y, x)), image.transpose(2, 0, 1))


def test_plain_nifti_and_rejections(spark, tmp_path):
    from voxtally.sources import nifti

    array = np.arange(60, dtype="<i2").reshape(3, 4, 5)
    path = tmp_path / "a.nii"
    path.write_bytes(nifti.header(array.shape, "int16") + array.tobytes())
    np.testing.assert_array_equal(from_voxels(open_volume(spark, path).voxels(), array.shape), array)
    raw = bytearray(nifti.header(array.shape, "int16"))
    struct.pack_into("<h", raw, 40, 4)
    (tmp_path / "b.nii.gz").write_bytes(gzip.compress(bytes(raw)))
    with pytest.raises(ValueError, match="4 dimensions"):
        open_volume(spark, tmp_path / "b.nii.gz")


def test_png_slices(spark, tmp_path):
    def png(image):
        def chunk(tag, data):
            return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

        rows = b"".join(b"\0" + r.tobytes() for r in image)
        head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, 0, 0, 0, 0)
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")

    array = np.random.default_rng(5).integers(0, 255, (3, 6, 7)).astype("uint8")
    folder = tmp_path / "png"
    folder.mkdir()
    for k, image in enumerate(array):
        (folder / f"s{k}.png").write_bytes(png(image))
    volume = open_volume(spark, folder)
    assert volume.meta.shape == (3, 6, 7)
    np.testing.assert_array_equal(from_voxels(volume.voxels(), array.shape), array)
    one = open_volume(spark, folder / "s1.png")
    assert one.meta.shape == (1, 6, 7)
    np.testing.assert_array_equal(from_blocks(one.blocks(), one.meta)[0], array[1])


def test_zarr_with_fill_and_fortran_order(spark, tmp_path):
    store = tmp_path / "f.zarr"
    store.mkdir()
    head = {
        "zarr_format": 2, "shape": [2, 3, 4], "chunks": [2, 3, 3], "dtype": ">u2", "compressor": None,
        "fill_value": 9, "order": "F", "filters": None, "dimension_separator": "/",
    }
    (store / ".zarray").write_text(json.dumps(head))
    chunk = np.arange(1, 19, dtype=">u2").reshape(2, 3, 3)
    (store / "0" / "0").mkdir(parents=True)
    (store / "0" / "0" / "0").write_bytes(chunk.tobytes(order="F"))
    want = np.full((2, 3, 4), 9)
    want[:, :, :3] = chunk
    np.testing.assert_array_equal(from_voxels(open_volume(spark, store).voxels(), (2, 3, 4)), want)


def test_partial_write_and_unknown_type(spark, tmp_path):
    array = np.ones((6, 3, 3), "uint8")
    path = write_volume(
        to_voxels(spark, array), VolumeMeta(array.shape, "uint8"), str(tmp_path), "v", "single-tiff", z_range=(2, 5)
    )
    assert path.endswith("v_z2-5.tiff")
    assert open_volume(spark, path).voxels().count() == 27
    with pytest.raises(ValueError):
        expected_output_path("x", "y", "bmp")
    with pytest.raises(ValueError):
        open_volume(spark, tmp_path / "missing.xyz")


@pytest.mark.parametrize("shape, dtype", [((3, 40_000, 40_000), "uint8"), ((70_000, 300, 300), "float32"), ((4, 6, 5), "int32")])
def test_tiff_headers_of_any_size(shape, dtype):
    """Page directories of classic and big files point at consecutive pixels."""
    import io

    from voxtally.sources import tiff

    head, offset = tiff.header(shape, dtype)
    order, pages = tiff._pages(io.BytesIO(head))
    page = shape[1] * shape[2] * np.dtype(dtype).itemsize
    assert order == "<" and len(head) == offset and len(pages) == shape[0]
    assert [p[tiff.OFFSETS][0] for p in pages[:3]] == [offset + k * page for k in range(3)]
    assert pages[-1][tiff.OFFSETS][0] == offset + (shape[0] - 1) * page
    assert all(p[tiff.COUNTS] == (page,) and p[tiff.HEIGHT] == (shape[1],) for p in pages)


def test_a_task_of_blocks_is_small_and_its_boxes_are_taken_one_by_one():
    """Whatever the volume's size, a worker holds few boxes at once."""
    import pyarrow as pa

    from voxtally.functions.boxes import block_rows
    from voxtally.sources.layout import BLOCK_TASK_BYTES
    from voxtally.sources.reader import Stack, VolumeReader

    big = Stack((layout.FileLayout("a", "tiff", (4096, 512, 512), "|u1", (4, 512, 512)),))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("voxtally.sources.reader.describe_stack", lambda path: big)
        tasks = VolumeReader({"path": "a", "layout": "blocks", "parallel": "4"}).partitions()
    assert max(sum(r.last - r.first for r in t.ranges) for t in tasks) << 20 <= BLOCK_TASK_BYTES
    assert sum(r.last - r.first for t in tasks for r in t.ranges) == 1024
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([b"abc", None])], names=["z0", "data"])
    rows = block_rows(batch)
    assert next(rows)["z0"] == 1
    rows = list(block_rows(batch))
    assert [r["z0"] for r in rows] == [1, 2] and bytes(rows[0]["data"]) == b"abc" and rows[1]["data"] is None
