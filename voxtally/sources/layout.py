"""How a volume is cut into boxes, and where the files of a volume are."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from math import prod

from voxtally.schema import Box, Shape

# Suffixes that select a format (fixed values).
TIFF_SUFFIXES = (".tif", ".tiff")
NIFTI_SUFFIXES = (".nii", ".nii.gz", ".gz")
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg", ".bmp")

# Raw bytes of one block and of one read task; a task of blocks may reach the next operator as one Arrow batch.
BLOCK_BYTES = 4 * 1024**2
TASK_BYTES = 128 * 1024**2
BLOCK_TASK_BYTES = 16 * 1024**2


@dataclass(frozen=True)
class FileLayout:
    """One stored array: its raw (Z, Y, X) shape, and the grid of readable boxes."""

    path: str
    kind: str
    shape: Shape
    dtype: str
    grid: Shape
    detail: dict = field(default_factory=dict, compare=False)
    sequential: bool = False

    def box_bytes(self) -> int:
        import numpy as np

        return prod(self.grid) * np.dtype(self.dtype).itemsize


def raster_grid(shape: Shape, itemsize: int, limit: int | None = None) -> Shape:
    """Largest boxes below the byte limit that stay contiguous in raster order."""
    limit = limit or BLOCK_BYTES
    z, y, x = shape
    row = max(1, x * itemsize)
    if y * row <= limit:
        return (max(1, min(z, limit // max(1, y * row))), max(1, y), max(1, x))
    return (1, max(1, min(y, limit // row)), max(1, x))


def grid_span(shape: Shape, grid: Shape, box: Box) -> Box:
    """Range of grid cells per axis that overlap a box."""
    return tuple(
        (max(0, a) // g, -(-min(s, b) // g) if min(s, b) > max(0, a) else max(0, a) // g)
        for s, g, (a, b) in zip(shape, grid, box)
    )


def grid_box(shape: Shape, grid: Shape, span: Box, index: int) -> Box:
    """The box of the index-th cell of a span, in raster order."""
    counts = [b - a for a, b in span]
    cell = (index // (counts[1] * counts[2]), index // counts[2] % counts[1], index % counts[2])
    starts = [(c + a) * g for c, (a, _), g in zip(cell, span, grid)]
    return tuple((o, min(o + g, s)) for o, g, s in zip(starts, grid, shape))


def clip(box: Box, limit: Box) -> Box:
    return tuple((max(a, c), min(b, d)) for (a, b), (c, d) in zip(box, limit))


def is_empty(box: Box) -> bool:
    return any(b <= a for a, b in box)


def suffix_of(path: str) -> str:
    name = os.path.basename(path.rstrip("/")).lower()
    if name.endswith(".nii.gz"):
        return ".nii.gz"
    return os.path.splitext(name)[1]


def kind_of(path: str) -> str:
    suffix = suffix_of(path)
    if suffix in TIFF_SUFFIXES:
        return "tiff"
    if suffix in NIFTI_SUFFIXES:
        return "nifti"
    if ".zarr" in path:
        return "zarr"
    if suffix in IMAGE_SUFFIXES:
        return "image"
    return ""


def volume_files(path: str) -> tuple[list[str], list[str]]:
    """Files of a volume in Z order, and the files of a folder that were skipped.

    In a folder the first readable suffix by name wins.
    """
    if kind_of(path):
        if not os.path.exists(path):
            raise FileNotFoundError(path)
        return [path], []
    if not os.path.isdir(path):
        raise ValueError(f"not a volume: {path}")
    chosen, skipped, first = [], [], None
    for name in sorted(os.listdir(path)):
        full = os.path.join(path, name)
        if not os.path.isfile(full) or not kind_of(full):
            continue
        first = first or suffix_of(full)
        (chosen if suffix_of(full) == first else skipped).append(full)
    if not chosen:
        raise FileNotFoundError(f"no volume files in {path}")
    return chosen, skipped
