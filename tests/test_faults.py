"""Inputs that must neither lose nor alter data without an error."""

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxtally.operators import coloc
from voxtally.schema import CELL_SCHEMA, VolumeMeta
from voxtally.sources import png, tables, zarr2
from voxtally.sources.reader import open_volume
from voxtally.sources.writer import _make_all, made_from, write_resized, write_volume


def frame(spark, array):
    rows = [(*map(int, p), array[tuple(p)].item()) for p in np.argwhere(array)]
    return spark.createDataFrame(rows, f"z int, y int, x int, value {'double' if array.dtype.kind == 'f' else 'bigint'}")


def stored(spark, folder, name, array, kind="zarr", **options):
    return open_volume(spark, write_volume(frame(spark, array), VolumeMeta(array.shape, array.dtype.name), str(folder), name, kind, **options))


def dense(volume):
    out = np.zeros(volume.meta.shape, volume.meta.dtype)
    for r in volume.voxels().collect():
        out[r.z, r.y, r.x] = r.value
    return out


@pytest.mark.parametrize("kind", ["zarr", "single-tiff", "single-nii"])
def test_real_values_stay_real(spark, tmp_path, kind):
    array = np.zeros((3, 4, 5), "float32")
    array[0, 0, 0], array[1, 2, 3], array[2, 3, 4], array[2, 0, 0] = 0.7, -0.5, np.nan, 3.25
    volume = stored(spark, tmp_path, "real", array, kind)
    np.testing.assert_array_equal(dense(volume), array)
    points = spark.createDataFrame([(0, 0, 0, 1), (1, 2, 3, 2), (2, 3, 4, 3), (2, 0, 0, 4), (-1, 0, 0, 5), (9, 9, 9, 6)], "z int, y int, x int, id int")
    for mask in (volume, volume.voxels()):
        found = {r.id: r.in_mask for r in coloc.points_in_mask(points, mask).collect()}
        assert found == {1: True, 2: False, 3: False, 4: True, 5: False, 6: False}
    grown = open_volume(spark, write_resized(volume, (3, 4, 10), str(tmp_path), "grown", "zarr", 0)) if kind != "single-nii" else None
    assert grown is None or dense(grown)[0, 0, 1] == np.float32(0.7)


def test_points_crowd_on_one_chunk(spark, tmp_path):
    array = np.zeros((8, 8, 8), "uint8")
    array[3, 3, 3] = 1
    volume = stored(spark, tmp_path, "m", array, chunk=(4, 4, 4))
    crowd = spark.range(5000).selectExpr("3 z", "3 y", "cast(3 + id % 2 as int) x", "id").unionByName(spark.createDataFrame([(None, 1, 1, -1)], "z int, y int, x int, id bigint"))
    got = coloc.points_in_volume(crowd, volume)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.x, r.in_mask): r["count"] for r in got.groupBy("x", "in_mask").count().collect()} == {(3, True): 2500, (4, False): 2500, (1, False): 1}


def test_image_names_and_depth(spark, tmp_path):
    rng = np.random.default_rng(1)
    for folder, dtype in (("a b+c%20", "uint8"), ("deep+ é", "uint16")):
        path = tmp_path / folder
        path.mkdir()
        array = rng.integers(1, np.iinfo(dtype).max, (3, 4, 5)).astype(dtype)
        for name, image in zip(("a 1+2", "a%200", "b#"), array):
            (path / f"{name}.png").write_bytes(png.encode(image))
        volume = open_volume(spark, path)
        assert volume.meta == VolumeMeta((3, 4, 5), dtype)
        names = sorted(("a 1+2", "a%200", "b#"))
        want = np.stack([array[("a 1+2", "a%200", "b#").index(n)] for n in names])
        np.testing.assert_array_equal(dense(volume), want)


def test_every_png_filter(tmp_path):
    image = np.random.default_rng(2).integers(0, 65536, (5, 7)).astype("uint16")
    big = image.astype(">u2").view(np.uint8).reshape(5, 14).astype(int)
    lines = []
    for y, kind in enumerate((0, 1, 2, 3, 4)):
        row = []
        for x in range(14):
            left, up, corner = (big[y, x - 2] if x > 1 else 0), (big[y - 1, x] if y else 0), (big[y - 1, x - 2] if y and x > 1 else 0)
            guess = (0, left, up, (left + up) // 2, png._paeth(left, up, corner))[kind]
            row.append((big[y, x] - guess) & 255)
        lines.append(bytes([kind, *row]))
    head = struct.pack(">IIBBBBB", 7, 5, 16, 0, 0, 0, 0)
    chunk = lambda tag, data: struct.pack(">I", len(data)) + tag + data + b"\0" * 4
    raw = png.MAGIC + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    np.testing.assert_array_equal(png.decode(raw), image)
    with pytest.raises(ValueError, match="grey"):
        png.decode(raw.replace(head, struct.pack(">IIBBBBB", 7, 5, 8, 2, 0, 0, 0)))


@pytest.mark.parametrize("row, message", [((0, 0, 0, 300), "fit"), ((-1, 0, 0, 1), "outside"), ((0, 4, 0, 1), "outside"), ((9, 0, 0, 1), "outside"), ((0, 0, 0, -1), "fit")])
def test_what_does_not_fit_is_an_error(spark, tmp_path, row, message):
    voxels = spark.createDataFrame([row], "z int, y int, x int, value bigint")
    with pytest.raises(Exception, match=message):
        write_volume(voxels, VolumeMeta((4, 4, 4), "uint8"), str(tmp_path), "v", "zarr", chunk=(3, 3, 3))
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("kind", ["zarr", "scroll-tiff"])
def test_slabs_add_up_to_one_store(spark, tmp_path, kind):
    array = np.random.default_rng(3).integers(0, 200, (10, 6, 7)).astype("uint8")
    whole = stored(spark, tmp_path, "whole", array, chunk=(4, 4, 4))
    for name, source in (("rows", frame(spark, array)), ("blocks", whole.blocks()), ("made", made_from(whole))):
        for slab in ((3, 6), (0, 3), (6, 10), (2, 4)):
            path = write_volume(source, whole.meta, str(tmp_path), name, kind, chunk=(4, 4, 4), z_range=slab)
        volume = open_volume(spark, path)
        assert volume.meta.shape == array.shape
        np.testing.assert_array_equal(dense(volume), array)


@pytest.mark.parametrize("kind", ["zarr", "scroll-tiff"])
def test_a_slab_written_again_replaces_all_its_slices(spark, tmp_path, kind):
    old = np.random.default_rng(4).integers(1, 200, (10, 9, 7)).astype("uint8")
    new = np.zeros_like(old)
    new[3, 2, 2] = 9
    meta, want = VolumeMeta(old.shape, "uint8"), old.copy()
    want[1:6] = new[1:6]
    whole = stored(spark, tmp_path, "whole", new, chunk=(4, 4, 4))
    for name, source in (("rows", frame(spark, new)), ("blocks", whole.blocks()), ("made", made_from(whole))):
        write_volume(frame(spark, old), meta, str(tmp_path), name, kind, chunk=(4, 4, 4), z_range=(0, 10))
        path = write_volume(source, meta, str(tmp_path), name, kind, chunk=(4, 4, 4), z_range=(1, 6))
        np.testing.assert_array_equal(dense(open_volume(spark, path)), want)


@pytest.mark.parametrize("change", [{"chunk": (2, 4, 4)}, {"codec": "blosc-lz4"}, {"dtype": "uint16"}, {"shape": (6, 5, 6)}, {"z_range": (4, 7)}])
def test_a_slab_that_does_not_fit_the_store_is_an_error(spark, tmp_path, change):
    array = np.arange(6 * 5 * 5, dtype="uint8").reshape(6, 5, 5)
    write_volume(frame(spark, array), VolumeMeta(array.shape, "uint8"), str(tmp_path), "v", "zarr", chunk=(4, 4, 4), z_range=(0, 6))
    options = {"chunk": (4, 4, 4), "z_range": (0, 3), "shape": array.shape, "dtype": "uint8", **change}
    meta = VolumeMeta(options.pop("shape"), options.pop("dtype"))
    with pytest.raises(ValueError, match="another|not in a volume"):
        write_volume(frame(spark, array), meta, str(tmp_path), "v", "zarr", **options)
    np.testing.assert_array_equal(dense(open_volume(spark, tmp_path / "v.zarr")), array)


def test_foreign_slices_are_an_error(spark, tmp_path):
    array = np.ones((4, 5, 5), "uint8")
    write_volume(frame(spark, array), VolumeMeta(array.shape, "uint8"), str(tmp_path), "v", "scroll-tiff", z_range=(0, 2))
    with pytest.raises(ValueError, match="another shape"):
        write_volume(frame(spark, array), VolumeMeta((4, 5, 6), "uint8"), str(tmp_path), "v", "scroll-tiff", z_range=(2, 4))


@pytest.mark.parametrize("kind", ["single-tiff", "single-nii"])
def test_a_range_of_a_single_file_from_any_kind_of_volume(spark, tmp_path, kind):
    array = np.random.default_rng(5).integers(0, 2000, (9, 6, 7)).astype("uint16")
    whole = stored(spark, tmp_path, "whole", array, chunk=(4, 4, 4))
    for name, source in (("rows", frame(spark, array)), ("blocks", whole.blocks()), ("made", made_from(whole))):
        path = write_volume(source, whole.meta, str(tmp_path), name, kind, z_range=(3, 8))
        np.testing.assert_array_equal(dense(open_volume(spark, path)), array[3:8])


def test_target_driven_writes_do_not_shuffle(spark, tmp_path):
    array = np.arange(5 * 6 * 7, dtype="uint16").reshape(5, 6, 7)
    source = stored(spark, tmp_path, "s", array, chunk=(2, 3, 4))
    done = _make_all(made_from(source, (10, 3, 7), 1, (1, 0, 2)), VolumeMeta((3, 10, 7), "uint16"), (2, 4, 7), lambda box, data: data.nbytes)
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()
    assert done.agg(F.sum("bytes")).first()[0] == 3 * 10 * 7 * 2


@pytest.mark.parametrize("codec", ["lz4", "zstd"])
def test_blosc_round_trip(codec):
    for data in (np.arange(200_001, dtype="<u4"), np.zeros(3, "<u2"), np.random.default_rng(0).integers(0, 255, 1000).astype("u1")):
        raw = zarr2.blosc_encode(data.tobytes(), data.itemsize, codec)
        assert struct.unpack("<I", raw[12:16])[0] == len(raw)
        assert zarr2.blosc_decode(raw) == data.tobytes()


def test_blosc_store_with_split_blocks(spark, tmp_path):
    """Two blocks, the first split into a stream per byte, the last one short and whole, as the common writers do."""
    chunk = np.arange(1, 7 * 10 * 10 + 1, dtype="<u2").reshape(7, 10, 10)
    block, data, out, starts = 1024, chunk.tobytes(), b"", []
    for k in range(0, len(data), block):
        part = data[k : k + block]
        planes = np.frombuffer(part, np.uint8).reshape(-1, 2).T
        starts.append(16 + 8 + out.__len__())
        for stream in (planes if len(part) == block else [planes]):
            plain = stream.tobytes()
            packed = pa.Codec("lz4_raw").compress(plain).to_pybytes()
            packed = packed if len(packed) < len(plain) else plain
            out += struct.pack("<I", len(packed)) + packed
    assert len(starts) == 2
    raw = struct.pack("<BBBBIII", 2, 1, 1 | 1 << 5, 2, len(data), block, 24 + len(out)) + struct.pack("<2I", *starts) + out
    store = tmp_path / "b.zarr"
    store.mkdir()
    head = {"zarr_format": 2, "shape": [7, 10, 10], "chunks": [7, 10, 10], "dtype": "<u2", "fill_value": 0, "order": "C", "filters": None,
            "compressor": {"id": "blosc", "cname": "lz4", "clevel": 5, "shuffle": 1, "blocksize": 0}}
    (store / ".zarray").write_text(json.dumps(head))
    (store / "0.0.0").write_bytes(raw)
    np.testing.assert_array_equal(dense(open_volume(spark, store)), chunk)
    assert zarr2.blosc_decode(struct.pack("<BBBBIII", 2, 1, 2, 1, 3, 3, 19) + b"abc") == b"abc"
    with pytest.raises(ValueError, match="Blosc"):
        zarr2.blosc_decode(struct.pack("<BBBBIII", 2, 1, 0, 1, 3, 3, 19) + b"abc")


def test_odd_ids_of_an_ontology(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("acronym,id,name,structure_id_path,parent_structure_id\na,NaN,A,/1/,inf\nb,1e300,B,/1/,NaN\nc,-inf,C,/1/,2.0\nd,7.0,D,/1/,\n")
    rows = {r.acronym: (r.id, r.parent_structure_id) for r in tables.read_structures(spark, path).collect()}
    assert rows == {"a": (0, None), "b": (0, None), "c": (0, 2), "d": (7, None)}


def test_backups_keep_their_order_and_a_cut_swap_is_put_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "cells.parquet")
    cells = spark.createDataFrame([(1, 0, 0, 0, 5, 1.0, "c", 0, 0, "B", "r", True)], CELL_SCHEMA)
    monkeypatch.setattr(tables.time, "time_ns", lambda: 5)  # a clock that stands still
    for n in range(5):
        tables.write_cells(cells.withColumn("cell_id", F.lit(n).cast("bigint")), path, stage="filter")
    kept = tables.list_backups(path, "filter")
    assert [spark.read.parquet(b).first().cell_id for b in kept] == [1, 2, 3]
    assert tables.read_cells(spark, path).first().cell_id == 4
    (tmp_path / "cells.parquet").rename(tmp_path / "cells.parquet.old-abc")
    assert tables.is_complete(spark, path) and tables.read_cells(spark, path).first().cell_id == 4


def test_own_gzip_files_are_read_by_member(spark, tmp_path, monkeypatch):
    from voxtally.sources import layout, nifti

    monkeypatch.setattr(layout, "BLOCK_BYTES", 200)
    array = np.random.default_rng(4).integers(0, 60_000, (5, 9, 11)).astype("uint16")
    volume = stored(spark, tmp_path, "v", array, "single-nii")
    found = nifti.describe(volume.path)
    assert not found.sequential and len(found.detail["members"]) == 5
    np.testing.assert_array_equal(dense(volume), array)
    part = volume.voxels((1, 2, 3), (4, 8, 9)).collect()
    assert {(r.z, r.y, r.x): r.value for r in part} == {(z, y, x): array[z, y, x] for z in range(1, 4) for y in range(2, 8) for x in range(3, 9) if array[z, y, x]}
    import gzip

    raw = gzip.decompress(open(volume.path, "rb").read())
    assert raw[352:] == array.tobytes()
    (tmp_path / "other.nii.gz").write_bytes(gzip.compress(raw))
    other = open_volume(spark, tmp_path / "other.nii.gz")
    assert nifti.describe(other.path).sequential
    np.testing.assert_array_equal(dense(other), array)


def test_tasks_carry_only_their_pages(spark, tmp_path, monkeypatch):
    import pickle

    from voxtally.sources import layout, reader

    monkeypatch.setattr(layout, "BLOCK_BYTES", 100)
    sizes = []
    for depth in (40, 400):
        array = np.ones((depth, 3, 4), "uint8")
        stack = reader.describe_stack(stored(spark, tmp_path, f"d{depth}", array, "single-tiff").path)
        whole = tuple((0, n) for n in stack.shape)
        sizes.append(max(len(pickle.dumps(t)) for t in reader.plan_tasks(stack, whole, depth)))
        np.testing.assert_array_equal(reader.read_box(stack, (0, 1, 2), ((depth - 3, depth), (0, 3), (0, 4))), array[:3])
    assert sizes[1] < 1.5 * sizes[0]


def test_scratch_tables_are_deleted(spark, tmp_path):
    from pathlib import Path

    from voxtally.session import cut_lineage, scratch, shared_dir

    before = set(Path(shared_dir(spark)).iterdir())
    with scratch(spark):
        assert cut_lineage(spark.range(5), "some").count() == 5
        assert set(Path(shared_dir(spark)).iterdir()) > before
    assert set(Path(shared_dir(spark)).iterdir()) == before
