"""Numpy helpers that run inside one task on one bounded box of a volume."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa


def forward_offsets(connectivity: int) -> list[tuple[int, int, int]]:
    """Half of the 6-, 18- or 26-neighbourhood: the offsets later in raster order."""
    reach = {6: 1, 18: 2, 26: 3}.get(connectivity)
    if reach is None:
        raise ValueError(f"connectivity must be 6, 18 or 26, got {connectivity}")
    return [o for o in product((-1, 0, 1), repeat=3) if o > (0, 0, 0) and sum(map(abs, o)) <= reach]


def block_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch of boxes; the ``data`` of one is taken out when its turn comes, not all at once."""
    for i in range(batch.num_rows):
        yield {name: column[i].as_buffer() if name == "data" else column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}


def smallest_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes, the smallest node reachable over the undirected links a-b."""
    parent = np.arange(n, dtype=np.int64)
    while a.size:
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(parent, hi, lo)
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return parent


def label_box(mask: np.ndarray, origin, shape, connectivity: int, z_chunk: int | None = None) -> dict[str, list]:
    """Components of one box, as sums that add up across boxes.

    Voxels are named by their raster index in the whole volume. Besides the sums
    each component lists its voxels on the faces of the box (``border``) and the
    voxels outside the box that it touches (``reach``). With ``z_chunk`` the
    contacts across a chunk boundary go to ``carry`` and are straight down only.
    """
    empty = {k: [] for k in ("root", "n", "sz", "sy", "sx", "border", "reach", "carry")}
    local = np.nonzero(mask)
    n = local[0].size
    if n == 0:
        return empty
    z, y, x = (axis.astype(np.int64) + o for axis, o in zip(local, origin))
    raster = (z * shape[1] + y) * shape[2] + x
    grid = np.full([s + 2 for s in mask.shape], -1, dtype=np.int32)
    grid[local[0] + 1, local[1] + 1, local[2] + 1] = np.arange(n, dtype=np.int32)
    face = np.zeros(n, dtype=bool)
    for axis, size in zip(local, mask.shape):
        face |= (axis == 0) | (axis == size - 1)
    at = np.flatnonzero(face)
    fz, fy, fx = z[at], y[at], x[at]

    links = []
    leaving: list[tuple[np.ndarray, np.ndarray, bool]] = []
    for oz, oy, ox in forward_offsets(connectivity):
        near = grid[local[0] + 1 + oz, local[1] + 1 + oy, local[2] + 1 + ox]
        hit = np.flatnonzero(near >= 0)
        links.append((hit, near[hit]))
        tz, ty, tx = fz + oz, fy + oy, fx + ox
        gone = np.zeros(at.size, dtype=bool)
        for t, start, size in zip((tz, ty, tx), origin, mask.shape):
            gone |= (t < start) | (t >= start + size)
        gone &= (tz < shape[0]) & (ty >= 0) & (ty < shape[1]) & (tx >= 0) & (tx < shape[2])
        target = (tz * shape[1] + ty) * shape[2] + tx
        crosses = gone & (tz // z_chunk != fz // z_chunk) if z_chunk else np.zeros(at.size, dtype=bool)
        within = np.flatnonzero(gone & ~crosses)
        leaving.append((at[within], target[within], False))
        if (oz, oy, ox) == (1, 0, 0):
            down = np.flatnonzero(crosses)
            leaving.append((at[down], target[down], True))
    parent = smallest_linked(n, np.concatenate([a for a, _ in links]), np.concatenate([b for _, b in links]))
    heads, label = np.unique(parent, return_inverse=True)
    k = heads.size

    def total(v):
        out = np.zeros(k, dtype=np.int64)
        np.add.at(out, label, v)
        return out

    def lists(owner, values):
        pairs = np.unique(np.stack([owner, values]), axis=1)
        cuts = np.searchsorted(pairs[0], np.arange(1, k))
        return np.split(pairs[1], cuts)

    def gather(carried):
        parts = [(label[i], t) for i, t, c in leaving if c == carried]
        if not parts:
            return [np.empty(0, np.int64)] * k
        return lists(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

    return {
        "root": raster[heads],
        "n": total(1),
        "sz": total(z),
        "sy": total(y),
        "sx": total(x),
        "border": lists(label[at], raster[at]),
        "reach": gather(False),
        "carry": gather(True),
    }
