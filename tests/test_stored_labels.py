"""Labels of stored volumes against plain numpy over whole arrays."""

import random
from types import SimpleNamespace

import numpy as np
import pytest

from voxtally.operators import atlas, report
from voxtally.operators.stored_labels import StoredLabels, stored_labels
from voxtally.schema import VolumeMeta
from voxtally.sources.reader import open_volume
from voxtally.sources.writer import write_volume

SHAPE = (9, 14, 11)


def _store(spark, folder, name, data, chunk, kind="zarr"):
    rows = [(*map(int, at), int(data[tuple(at)])) for at in np.argwhere(data)]
    voxels = spark.createDataFrame(rows, "z int, y int, x int, value bigint")
    options = {"chunk": chunk} if kind == "zarr" else {}
    return open_volume(spark, write_volume(voxels, VolumeMeta(SHAPE, "uint16"), str(folder), name, kind, **options))


@pytest.fixture(scope="module")
def brain(spark, tmp_path_factory):
    folder, rng = tmp_path_factory.mktemp("atlas"), np.random.default_rng(3)
    ids = rng.choice([0, 0, 5, 7, 300, 40_000], SHAPE).astype(np.uint16)
    sides = rng.choice([0, 1, 2], SHAPE).astype(np.uint16)
    ids[:4, :5] = 0  # a chunk that is never written
    return SimpleNamespace(
        ids=ids, sides=sides, annotation=_store(spark, folder, "ids", ids, (4, 5, 6)), hemisphere=_store(spark, folder, "sides", sides, (3, 9, 4)),
        tiff=_store(spark, folder, "tiff", ids, None, "single-tiff"),
    )


def _counts(found):
    return {r.id: (r.total_voxels, r.left_voxels, r.right_voxels) for r in found.collect()}


def _expected(ids, left, right):
    return {int(i): tuple(int(((ids == i) & m).sum()) for m in (np.ones(SHAPE, bool), left, right)) for i in np.unique(ids) if i}


def test_voxels_by_side_equal_numpy_and_the_voxel_table(brain):
    labels = StoredLabels(brain.annotation, brain.hemisphere)
    found = _counts(report.region_voxel_counts(labels))
    assert found == _expected(brain.ids, brain.sides == 1, brain.sides == 2)
    assert found == _counts(report.region_voxel_counts(atlas.label_table(brain.annotation.voxels(), brain.hemisphere.voxels())))


@pytest.mark.parametrize("store", ["annotation", "tiff"])
def test_voxels_by_midline_and_without_sides(brain, store):
    labels = stored_labels(getattr(brain, store))
    left = np.broadcast_to(np.arange(SHAPE[2]) < 5, SHAPE)
    assert _counts(report.region_voxel_counts(labels, midline=5)) == _expected(brain.ids, left, ~left)
    none = np.zeros(SHAPE, bool)
    assert _counts(report.region_voxel_counts(labels)) == _expected(brain.ids, none, none)


def test_points_read_the_voxel_that_they_fall_in(spark, brain):
    rng, native = random.Random(2), (18, 28, 33)
    points = [(i, *(rng.randrange(-3, n + 4) for n in native)) for i in range(300)]
    points += [(1000 + i, 1, 20, 9) for i in range(400)] + [(2000, None, 1, 1), (2000, None, 1, 1)]  # one hot voxel, no place, a repeated row
    table = spark.createDataFrame(points, "cell_id bigint, z int, y int, x int")
    for hemisphere in (brain.hemisphere, None):
        found = atlas.lookup_labels(table, StoredLabels(brain.annotation, hemisphere), native, SHAPE)
        plain = atlas.lookup_labels(table, atlas.label_table(brain.annotation.voxels(), hemisphere and hemisphere.voxels()), native, SHAPE)
        assert found.schema.names == plain.schema.names
        assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect()))
    assert found.limit(0).unionByName(found.filter("cell_id < 0")).count() == 0


def test_no_voxel_rows_and_no_join_in_the_plans(spark, brain, capsys):
    labels = StoredLabels(brain.annotation, brain.hemisphere)
    points = spark.createDataFrame([(1, 2, 3, 4)], "cell_id bigint, z int, y int, x int")
    report.region_voxel_counts(labels).explain()
    atlas.lookup_labels(points, labels, SHAPE, SHAPE).explain()
    plan = capsys.readouterr().out
    assert "MapInArrow" in plan and "Join" not in plan


def test_unlike_shapes_are_refused(spark, brain, tmp_path):
    small = spark.createDataFrame([(0, 0, 0, 1)], "z int, y int, x int, value bigint")
    other = open_volume(spark, write_volume(small, VolumeMeta((2, 2, 2), "uint16"), str(tmp_path), "small", "zarr"))
    assert stored_labels(brain.annotation, other) is None
    with pytest.raises(ValueError, match="hemisphere volume"):
        StoredLabels(brain.annotation, other)
    with pytest.raises(ValueError, match="stored atlas"):
        atlas.lookup_labels(small, StoredLabels(brain.annotation), SHAPE, (2, 2, 2))
