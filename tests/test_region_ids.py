"""Regions with many descendants: their ids are looked up inside tasks."""

import numpy as np
import pytest

from voxtally.operators.structures import find_region
from voxtally.plans import brain_runs
from voxtally.schema import VolumeMeta
from voxtally.sources.ids import stored_ids
from voxtally.sources.reader import open_volume
from voxtally.sources.writer import write_volume


def test_the_driver_gets_no_list_of_ids(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(1, "all", "All", "/1/"), (7000, "none", "None", "/1/7000/"), (3, "half", "Half", "/1/3/"), (None, "x", "X", "/1/3/9/")]
    rows += [(10 + i, f"c{i}", f"C{i}", f"/1/3/{10 + i}/") for i in range(0, 6000, 2)]
    structures = spark.createDataFrame(rows, "id bigint, acronym string, name string, structure_id_path string")
    data = rng.integers(0, 6020, (6, 20, 12))
    at = np.nonzero(data)
    voxels = spark.createDataFrame([tuple(map(int, r)) for r in zip(*at, data[at])], "z int, y int, x int, value bigint")
    annotation = open_volume(spark, write_volume(voxels, VolumeMeta(data.shape, "uint32"), str(tmp_path), "a", "zarr", chunk=(4, 8, 8)))
    sizes, kind = [], type(structures)
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: sizes.append(collect(self)) or sizes[-1])
    native = (12, 20, 24)
    path = brain_runs.extract_region(annotation, structures, find_region(structures, "half"), native, str(tmp_path), "half")
    assert brain_runs.extract_region(annotation, structures, find_region(structures, "none"), native, str(tmp_path), "none") is None
    assert sum(map(len, sizes)) < 100
    monkeypatch.undo()
    near = [np.arange(n) * s // n for n, s in zip(native, data.shape)]
    ids = [r[0] for r in rows if r[0] and r[3].startswith("/1/3/")]
    expected = np.where(np.isin(data, ids), 3, 0)[np.ix_(*near)]
    got = np.zeros(native, int)
    for r in open_volume(spark, path).voxels().collect():
        got[r.z, r.y, r.x] = r.value
    assert np.array_equal(got, expected) and not list(tmp_path.glob("ids-*"))


@pytest.mark.parametrize("kind", ["uint8", "int16", "uint32", "uint64", "int64", "float32", "float64"])
def test_lookup_equals_membership(spark, kind):
    ids = spark.createDataFrame([(v,) for v in [5, -3, 0, 250, 1 << 40, None, 90_000, *range(1000, 40_000, 3)]], "id bigint").repartition(7)
    rng = np.random.default_rng(1)
    data = rng.integers(0, 120, (4, 5, 60)).astype(kind) if kind == "uint8" else rng.integers(0, 32_000, (4, 5, 60)).astype(kind)
    data.ravel()[:3] = [5, 0, 250 if kind != "int16" else 1003]
    if kind.startswith("f"):
        data.ravel()[3:7] = [np.nan, np.inf, 5.5, -3]
    if kind == "uint64":
        data.ravel()[3] = 2**64 - 3
    known = {r.id for r in ids.collect()} - {None}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    with stored_ids(ids) as stored:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert len(stored.parts) > 1
        found = stored.holds(data)
        assert found.shape == data.shape and found.ravel().tolist() == [v in known for v in data.ravel().tolist()]
        assert stored.holds(data[:0]).shape == data[:0].shape
    with stored_ids(ids.limit(0)) as stored:
        assert not stored.holds(data).any()
