"""Resampling against direct numpy computation in exact integers."""

import numpy as np
import pytest

from voxtally.operators import volume



def to_voxels(spark, array):
    rows = [(*map(int, p), int(array[tuple(p)])) for p in np.argwhere(array)]
    return spark.createDataFrame(rows, "z int, y int, x int, value bigint")


def dense(df, shape):
    out = np.zeros(shape, np.int64)
    for r in df.collect():
        out[r.z, r.y, r.x] = r.value
    return out


def linear_axis(array, axis, t):
    """Numerators of linear interpolation out of 2t along one axis, mirrored ends."""
    n = array.shape[axis]
    a = np.moveaxis(array, axis, 0)
    out = np.zeros((t, *a.shape[1:]), np.int64)
    for j in range(t):
        pos = abs((2 * j + 1) * n - t) if n > 1 else 0
        top = (n - 1) * 2 * t
        pos = 2 * top - pos if pos > top else pos
        i, w = divmod(pos, 2 * t)
        out[j] = a[i] * (2 * t - w) + (a[i + 1] * w if w else 0)
    return np.moveaxis(out, 0, axis)


SHAPES = [((4, 8, 8), (4, 4, 4)), ((3, 5, 7), (7, 11, 6)), ((6, 1, 4), (2, 3, 9)), ((5, 6, 7), (5, 6, 7)), ((2, 9, 2), (1, 2, 1))]


@pytest.mark.parametrize("source, target", SHAPES)
def test_nearest(spark, source, target):
    array = np.random.default_rng(1).integers(0, 5, source)
    picks = [(2 * np.arange(t) + 1) * s // (2 * t) for s, t in zip(source, target)]
    got = dense(volume.resample(to_voxels(spark, array), source, target), target)
    np.testing.assert_array_equal(got, array[np.ix_(*picks)])


@pytest.mark.parametrize("source, target", SHAPES)
def test_linear(spark, source, target):
    array = np.random.default_rng(2).integers(0, 4000, source)
    plane, scale = array, 1
    for axis in (1, 2):
        if source[axis] != target[axis]:
            plane, scale = linear_axis(plane, axis, target[axis]), scale * 2 * target[axis]
    want = plane // scale
    if source[0] != target[0]:
        want = linear_axis(want, 0, target[0]) // (2 * target[0])
    got = dense(volume.resample(to_voxels(spark, array), source, target, order=1), target)
    np.testing.assert_array_equal(got, want)


@pytest.mark.parametrize("source, target", SHAPES)
def test_boxes_agree_with_voxels(spark, source, target):
    array = np.random.default_rng(3).integers(0, 4000, source).astype("int32")
    voxels = to_voxels(spark, array)

    def read(box):
        return array[tuple(slice(a, b) for a, b in box)]

    for order in (0, 1):
        got = np.zeros(target, "int32")
        for z in range(0, target[0], 2):
            for y in range(0, target[1], 3):
                box = ((z, min(z + 2, target[0])), (y, min(y + 3, target[1])), (0, target[2]))
                got[tuple(slice(a, b) for a, b in box)] = volume.resized_box(read, source, target, box, order)
        np.testing.assert_array_equal(got, dense(volume.resample(voxels, source, target, order), target))


def test_real_values_are_weighed_without_truncation():
    array = np.array([0.0, 1.0], "float32").reshape(2, 1, 1)
    got = volume.resized_box(lambda box: array[box[0][0] : box[0][1]], (2, 1, 1), (4, 1, 1), ((0, 4), (0, 1), (0, 1)), 1)
    np.testing.assert_allclose(got.ravel(), [0.25, 0.25, 0.75, 0.75])


def test_registration_input_and_pyramid(spark):
    array = np.zeros((20, 40, 60), np.int64)
    array[4:8, 8:16, 12:24] = 1000
    small, shape = volume.registration_input(to_voxels(spark, array), array.shape, (2, 4, 6), (1, 0, 2))
    assert shape == (10, 10, 10)
    out = dense(small, shape)
    assert out[3, 3, 3] == 1000 and out[9, 9, 9] == 0
    assert volume.pyramid_shapes((9, 4, 1), 4) == [(9, 4, 1), (4, 2, 1), (2, 1, 1), (1, 1, 1)]
    levels = volume.pyramid(to_voxels(spark, array), array.shape, 3)
    np.testing.assert_array_equal(dense(levels[1], (10, 20, 30)), array[1::2, 1::2, 1::2])


def test_crop(spark):
    array = np.arange(60).reshape(3, 4, 5)
    got = dense(volume.crop(to_voxels(spark, array), (1, 1, 2), (3, 3, 5)), (2, 2, 3))
    np.testing.assert_array_equal(got, array[1:3, 1:3, 2:5])
    assert volume.crop(to_voxels(spark, array), (2, 0, 0), (1, 4, 5)).count() == 0


def test_growing_axes_spread_after_the_shuffle(spark):
    """What is shuffled are the voxels that go into a step, never those that come out."""
    voxels = spark.createDataFrame([(z, y, x, z + y * x + 1) for z in range(3) for y in range(4) for x in range(5)], "z int, y int, x int, value bigint")
    plan = volume.resample(voxels, (3, 4, 5), (7, 9, 11), order=1)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 3
    assert all(len(line.split("hashpartitioning(")[1].split("),")[0].split(", ")) <= 3 for line in dealt), dealt
