"""NIfTI-1 volumes, plain or gzip-compressed; stored (X, Y, Z), used (Z, Y, X)."""

from __future__ import annotations

import gzip
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np

from voxtally.schema import Shape
from voxtally.sources.layout import Box, FileLayout, raster_grid

# NIfTI-1 datatype codes (fixed values).
DTYPES = {
    2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8", 256: "i1", 512: "u2", 768: "u4", 1024: "i8", 1280: "u8",
}
CODES = {v: k for k, v in DTYPES.items()}


def _open(path: str):
    return gzip.open(path, "rb") if path.lower().endswith(".gz") else open(path, "rb")


# Tag of the extra field in which a gzip member written here states its own size (fixed value).
MEMBER_TAG = b"VX"


def gzip_member(raw: bytes) -> bytes:
    """One gzip member that says how long it is, so that readers can go from member to member."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    size = 24 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", 12) + MEMBER_TAG + struct.pack("<HQ", 8, size)
    return head + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def members(path: str) -> list[int]:
    """Where the members of a file start, if all of them say how long they are; else nothing."""
    found, at, end = [], 0, os.path.getsize(path)
    with open(path, "rb") as f:
        while at < end:
            f.seek(at)
            head = f.read(24)
            if head[:4] != b"\x1f\x8b\x08\x04" or head[12:14] != MEMBER_TAG:
                return []
            found.append(at)
            at += struct.unpack("<Q", head[16:24])[0]
    return found


def describe(path: str) -> FileLayout:
    with _open(path) as f:
        head = f.read(348)
    order = "<" if struct.unpack("<i", head[:4])[0] == 348 else ">"
    dims = struct.unpack(f"{order}8h", head[40:56])
    sizes = [int(v) for v in dims[1 : 1 + dims[0]]]
    if len(sizes) > 3:
        raise ValueError(f"{path}: NIfTI with {len(sizes)} dimensions is not supported")
    x, y, z = sizes + [1] * (3 - len(sizes))
    (code,) = struct.unpack(order + "h", head[70:72])
    offset, slope, shift = struct.unpack(order + "3f", head[108:120])
    if code not in DTYPES:
        raise ValueError(f"{path}: NIfTI datatype {code} is not supported")
    stored = np.dtype(order + DTYPES[code])
    scaled = slope not in (0.0,) and not np.isnan(slope) and (slope, shift) != (1.0, 0.0)
    detail = {"offset": int(offset), "stored": stored.str, "slope": slope if scaled else None, "shift": shift}
    dtype = "<f8" if scaled else stored.str
    shape = (z, y, x)
    grid, packed = raster_grid(shape, stored.itemsize), path.lower().endswith(".gz")
    if packed:
        starts = members(path)  # the header, then one member a box
        detail["members"] = starts[1:] if len(starts) == 1 + -(-z // grid[0]) * -(-y // grid[1]) else []
    return FileLayout(path, "nifti", shape, dtype, grid, detail, packed and not detail["members"])


def _member_rows(layout: FileLayout, f, box: Box, stored: np.dtype) -> np.ndarray:
    """A box from its own member."""
    (z0, z1), (y0, y1), (x0, x1) = box
    depth, rows, _ = layout.grid
    shape = [min(g, n - b // g * g) for g, n, b in zip(layout.grid, layout.shape, (z0, y0, 0))]
    f.seek(layout.detail["members"][z0 // depth * -(-layout.shape[1] // rows) + y0 // rows])
    raw = zlib.decompressobj(31).decompress(_whole_member(f))
    inner = [slice(a % g, a % g + b - a) for (a, b), g in ((box[0], depth), (box[1], rows))]
    return np.frombuffer(raw, stored).reshape(shape)[inner[0], inner[1], x0:x1]


def _whole_member(f) -> bytes:
    head = f.read(24)
    return head + f.read(struct.unpack("<Q", head[16:24])[0] - 24)


def read_boxes(layout: FileLayout, boxes) -> Iterator[tuple[Box, np.ndarray]]:
    """Read boxes from their members, or in file order; a file without sized members is decompressed once, in passing."""
    d = layout.detail
    stored = np.dtype(d["stored"])
    _, height, width = layout.shape
    with open(layout.path, "rb") if d.get("members") else _open(layout.path) as f:
        for box in boxes:
            (z0, z1), (y0, y1), (x0, x1) = box
            if d.get("members"):
                data = _member_rows(layout, f, box, stored)
            else:
                rows = []
                for z in range(z0, z1):
                    f.seek(d["offset"] + ((z * height) + y0) * width * stored.itemsize)
                    raw = f.read((y1 - y0) * width * stored.itemsize)
                    rows.append(np.frombuffer(raw, stored).reshape(y1 - y0, width)[:, x0:x1])
                data = np.stack(rows)
            if d["slope"] is not None:
                data = data.astype("f8") * d["slope"] + d["shift"]
            yield box, data


def header(shape: Shape, dtype: str) -> bytes:
    z, y, x = shape
    kind = np.dtype("u1" if dtype == "bool" else dtype)
    head = bytearray(352)
    struct.pack_into("<i", head, 0, 348)
    struct.pack_into("<8h", head, 40, 3, x, y, z, 1, 1, 1, 1)
    struct.pack_into("<2h", head, 70, CODES[kind.str[1:]], kind.itemsize * 8)
    struct.pack_into("<8f", head, 76, 1, 1, 1, 1, 1, 1, 1, 1)
    struct.pack_into("<3f", head, 108, 352.0, float("nan"), float("nan"))
    struct.pack_into("<2h", head, 252, 0, 2)
    for row in range(3):
        struct.pack_into("<4f", head, 280 + 16 * row, *[1.0 if c == row else 0.0 for c in range(4)])
    head[344:348] = b"n+1\0"
    return bytes(head)
