"""Connected components against brute-force flood fill."""

from collections import deque

import numpy as np
import pytest

from voxtally.functions.boxes import forward_offsets
from voxtally.operators import components as comp
from voxtally.operators import graph
from voxtally.schema import VolumeMeta


def voxel_frame(spark, mask):
    rows = [tuple(int(v) for v in p) for p in np.argwhere(mask)]
    return spark.createDataFrame(rows, "z int, y int, x int")


def block_frame(spark, volume, step):
    rows = []
    for z in range(0, volume.shape[0], step[0]):
        for y in range(0, volume.shape[1], step[1]):
            for x in range(0, volume.shape[2], step[2]):
                box = np.ascontiguousarray(volume[z : z + step[0], y : y + step[1], x : x + step[2]])
                rows.append((z, y, x, *box.shape, bytearray(box.tobytes())))
    return spark.createDataFrame(rows, "z0 int, y0 int, x0 int, dz int, dy int, dx int, data binary")


def flood(mask, connectivity):
    offsets = [o for f in forward_offsets(connectivity) for o in (f, tuple(-v for v in f))]
    seen, out = np.zeros(mask.shape, bool), set()
    for start in map(tuple, np.argwhere(mask)):
        if seen[start]:
            continue
        seen[start] = True
        queue, members = deque([start]), []
        while queue:
            p = queue.popleft()
            members.append(p)
            for o in offsets:
                q = tuple(a + b for a, b in zip(p, o))
                if all(0 <= a < s for a, s in zip(q, mask.shape)) and mask[q] and not seen[q]:
                    seen[q] = True
                    queue.append(q)
        arr = np.array(members)
        root = int(np.ravel_multi_index(start, mask.shape))
        out.add((root, len(members), *(int(v) for v in arr.sum(axis=0) // len(members))))
    return out


def as_set(df):
    return {tuple(r) for r in df.select("root", "n", "z", "y", "x").collect()}


@pytest.mark.parametrize("connectivity", [6, 18, 26])
def test_random_voxels_match_flood_fill(spark, connectivity, monkeypatch):
    monkeypatch.setattr(comp, "BRICK", 5)
    rng = np.random.default_rng(connectivity)
    mask = rng.random((13, 11, 12)) < 0.2
    meta = VolumeMeta(mask.shape, "uint8")
    found = comp.components(voxel_frame(spark, mask), meta, connectivity)
    assert as_set(found) == flood(mask, connectivity)


def test_dense_blocks_match_flood_fill(spark, monkeypatch):
    monkeypatch.setattr(comp, "LABEL_SIDE", 3)
    rng = np.random.default_rng(7)
    mask = rng.random((9, 14, 10)) < 0.3
    meta = VolumeMeta(mask.shape, "uint8")
    found = comp.components(block_frame(spark, mask.astype("uint8"), (4, 5, 6)), meta, 18)
    assert as_set(found) == flood(mask, 18)


@pytest.mark.parametrize("together", [7, 10**6])
def test_star_and_chain_are_joined_over_rounds(spark, monkeypatch, together):
    monkeypatch.setattr(graph, "CONTRACT_ROWS", together)
    star = [(0, i) for i in range(1, 200)] + [(i, i + 1000) for i in range(1, 200, 3)]
    chain = [(5000 + i, 5001 + i) for i in range(60)]
    edges = spark.createDataFrame(star + chain, "a bigint, b bigint").repartition(7)
    got = {tuple(r) for r in graph.connected_components(edges).collect()}
    want = {(n, 0) for e in star for n in e} | {(n, 5000) for e in chain for n in e}
    assert got == want


def three_blobs():
    mask = np.zeros((10, 8, 8), dtype="uint8")
    mask[0:2, 0:2, 0:2] = 1
    mask[3:6, 4:6, 4:6] = 1
    mask[8:10, 0:2, 6:8] = 1
    return mask


@pytest.mark.parametrize("merge", ["exact", "chunked"])
def test_three_blobs(spark, merge):
    mask = three_blobs()
    cells = comp.detect_cells(
        voxel_frame(spark, mask), VolumeMeta(mask.shape, "uint8"), "cFos", "B1", "r1", (4.0, 2.0, 2.0), merge=merge, z_chunk=4
    ).orderBy("cell_id").collect()
    assert [c.cell_id for c in cells] == [1, 2, 3]
    assert [c.volume_voxels for c in cells] == [8, 12, 8]
    assert cells[1].volume_um3 == 12 * 16.0
    assert not any(c.passed_filter for c in cells) and all(c.region_id is None for c in cells)


@pytest.mark.parametrize(
    "voxels, shape, exact, chunked",
    [
        ([(0, 0, 0), (1, 0, 0), (2, 1, 0), (3, 1, 0)], (4, 4, 6), [(1, 0, 0, 4)], [(0, 0, 0, 2), (2, 1, 0, 2)]),
        (
            [(z, 0, x) for z in (0, 1) for x in (0, 4)] + [(z, 0, x) for z in (2, 3) for x in range(5)],
            (4, 2, 7),
            [(1, 0, 2, 14)],
            [(0, 0, 4, 2), (2, 0, 1, 12)],
        ),
    ],
)
@pytest.mark.parametrize("dense", [False, True])
def test_chunk_rule_differs_as_expected(spark, voxels, shape, exact, chunked, dense):
    mask = np.zeros(shape, "uint8")
    for v in voxels:
        mask[v] = 1
    volume = block_frame(spark, mask, (3, 2, 4)) if dense else voxel_frame(spark, mask)
    meta = VolumeMeta(shape, "uint8")
    for merge, want in (("exact", exact), ("chunked", chunked)):
        found = comp.components(volume, meta, 18, merge, 2)
        assert sorted(tuple(r) for r in found.select("z", "y", "x", "n").collect()) == sorted(want)


def test_empty_mask(spark):
    none = spark.createDataFrame([], "z int, y int, x int")
    cells = comp.detect_cells(none, VolumeMeta((4, 4, 4), "uint8"), "cFos", "B1", "r1", (1.0, 1.0, 1.0))
    assert cells.count() == 0 and cells.columns[0] == "cell_id"


def test_numbering_by_range(spark, monkeypatch):
    monkeypatch.setattr(comp, "ROWS_PER_RANGE", 100)
    rows = spark.range(0, 3000, 3).withColumnRenamed("id", "root")
    got = comp.number_in_order(rows, "root", "cell_id").orderBy("root").collect()
    assert [r.cell_id for r in got] == list(range(1, 1001))


def chunk_rule(mask, connectivity, depth):
    """Sequential statement of the chunk rule: a component continues the first label above it."""
    above, members, fresh = None, {}, 0
    for z0 in range(0, mask.shape[0], depth):
        part = mask[z0 : z0 + depth]
        local = np.zeros(part.shape, int)
        queue_of = {tuple(p) for p in np.argwhere(part)}
        offsets = [o for f in forward_offsets(connectivity) for o in (f, tuple(-v for v in f))]
        groups = []
        while queue_of:
            stack = [min(queue_of)]
            queue_of.discard(stack[0])
            group = []
            while stack:
                p = stack.pop()
                group.append(p)
                for o in offsets:
                    q = tuple(a + b for a, b in zip(p, o))
                    if q in queue_of:
                        queue_of.discard(q)
                        stack.append(q)
            groups.append(sorted(group))
        for group in groups:
            top = [(y, x) for z, y, x in group if z == 0 and above is not None and above[y, x]]
            if top:
                name = above[min(top)]
            else:
                fresh += 1
                name = fresh
            for p in group:
                local[p] = name
                members.setdefault(name, []).append((p[0] + z0, p[1], p[2]))
        above = local[-1]
    out = set()
    for voxels in members.values():
        arr = np.array(sorted(voxels))
        out.add((int(np.ravel_multi_index(arr[0], mask.shape)), len(arr), *(int(v) for v in arr.sum(axis=0) // len(arr))))
    return out


@pytest.mark.parametrize("dense", [False, True])
def test_random_chunk_rule_matches_the_sequential_one(spark, dense, monkeypatch):
    monkeypatch.setattr(comp, "BRICK", 4)
    mask = np.random.default_rng(11).random((14, 9, 10)) < 0.25
    meta = VolumeMeta(mask.shape, "uint8")
    volume = block_frame(spark, mask.astype("uint8"), (6, 5, 7)) if dense else voxel_frame(spark, mask)
    assert as_set(comp.components(volume, meta, 18, "chunked", 3)) == chunk_rule(mask, 18, 3)


def test_blob_inside_a_box_and_empty_blocks(spark):
    mask = np.zeros((12, 12, 12), "uint8")
    mask[2:4, 2:4, 2:4] = 1
    found = comp.components(block_frame(spark, mask, (6, 6, 6)), VolumeMeta(mask.shape, "uint8"), 18)
    assert as_set(found) == {(2 * 144 + 2 * 12 + 2, 8, 2, 2, 2)}
