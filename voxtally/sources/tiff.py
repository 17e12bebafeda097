"""Baseline and Big TIFF: page layout, box reads and headers for parallel writes."""

from __future__ import annotations

import logging
import re
import struct
import zlib
from dataclasses import replace

import numpy as np

from voxtally.schema import Shape
from voxtally.sources.layout import Box, FileLayout, raster_grid

log = logging.getLogger(__name__)

# Tag numbers and field types of the TIFF 6.0 specification (fixed values).
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, DESCRIPTION = 256, 257, 258, 259, 262, 270
OFFSETS, SAMPLES, ROWS, COUNTS, PLANAR, PREDICTOR = 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, FORMAT = 322, 323, 324, 325, 339
FIELD = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
FORMAT_LETTER = {1: "u", 2: "i", 3: "f"}
PLAIN, DEFLATE, OLD_DEFLATE = 1, 8, 32946
# Sample types that an ImageJ header may declare (fixed values).
IMAGEJ_DTYPES = ("bool", "uint8", "uint16", "float32")


def _pages(f) -> tuple[str, list[dict]]:
    head = f.read(16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    if order is None:
        raise ValueError("not a TIFF file")
    big = struct.unpack(order + "H", head[2:4])[0] == 43
    at = struct.unpack(order + ("Q" if big else "I"), head[8:16] if big else head[4:8])[0]
    count_fmt, entry_size, slot, next_fmt = ("Q", 20, 8, "Q") if big else ("H", 12, 4, "I")
    pages = []
    while at:
        f.seek(at)
        (n,) = struct.unpack(order + count_fmt, f.read(struct.calcsize(count_fmt)))
        raw = f.read(n * entry_size)
        (at,) = struct.unpack(order + next_fmt, f.read(slot))
        page = {}
        for k in range(n):
            entry = raw[k * entry_size : (k + 1) * entry_size]
            tag, kind = struct.unpack(order + "HH", entry[:4])
            (values,) = struct.unpack(order + ("Q" if big else "I"), entry[4 : 4 + slot])
            fmt = FIELD.get(kind)
            if fmt is None:
                continue
            size = values * struct.calcsize(fmt)
            if size <= slot:
                data = entry[4 + slot :][:size]
            else:
                f.seek(struct.unpack(order + ("Q" if big else "I"), entry[4 + slot :])[0])
                data = f.read(size)
            page[tag] = data if fmt == "s" else struct.unpack(f"{order}{values}{fmt}", data)
        pages.append(page)
    return order, pages


def describe(path: str) -> FileLayout:
    with open(path, "rb") as f:
        order, pages = _pages(f)

    def one(page, tag, default=None):
        return page.get(tag, (default,))[0]

    size = {}
    for page in pages:
        key = (one(page, HEIGHT), one(page, WIDTH), one(page, BITS, 1), one(page, FORMAT, 1), one(page, SAMPLES, 1))
        size.setdefault(key, []).append(page)
    key = max(size, key=lambda k: (k[0] * k[1], len(size[k])))
    height, width, bits, fmt, samples = key
    chosen = size[key]
    if bits % 8:
        raise ValueError(f"{path}: {bits}-bit samples are not supported")
    dtype = np.dtype(f"{order}{FORMAT_LETTER[fmt]}{bits // 8}")
    first = chosen[0]
    compression = one(first, COMPRESSION, PLAIN)
    if compression not in (PLAIN, DEFLATE, OLD_DEFLATE):
        raise ValueError(f"{path}: TIFF compression {compression} is not supported")
    tiled = TILE_OFFSETS in first
    slots = [(p[TILE_OFFSETS], p[TILE_COUNTS]) if tiled else (p[OFFSETS], p[COUNTS]) for p in chosen]
    images = re.search(rb"ImageJ=[\s\S]*?images=(\d+)", first.get(DESCRIPTION, b""))
    if images and len(pages) == 1 and int(images[1]) > 1 and compression == PLAIN:
        step = height * width * samples * dtype.itemsize
        slots = [((slots[0][0][0] + k * step,), (step,)) for k in range(int(images[1]))]
        first = {**first, ROWS: (height,)}
    detail = {
        "slots": slots,
        "tile": (one(first, TILE_HEIGHT), one(first, TILE_WIDTH)) if tiled else (min(one(first, ROWS, height), height), width),
        "deflate": compression != PLAIN,
        "predictor": one(first, PREDICTOR, 1),
        "samples": samples,
        "planar": one(first, PLANAR, 1) == 2,
    }
    if samples > 1:
        log.warning("%s: the %d samples of a pixel become slices along Z", path, samples)
    shape = (len(slots) * samples, height, width)
    grid = raster_grid(shape, dtype.itemsize)
    if detail["deflate"]:
        rows = detail["tile"][0]
        grid = (grid[0], min(height, max(rows, grid[1] // rows * rows)), width)
    if samples > 1:
        grid = (samples, *grid[1:])
    return FileLayout(path, "tiff", shape, dtype.str, grid, detail)


def with_pages(layout: FileLayout, z0: int, z1: int) -> FileLayout:
    """The layout with the directory entries of some slices only, for the task that reads them."""
    first, samples = layout.detail.get("first", 0), layout.detail["samples"]
    a, b = z0 // samples, -(-z1 // samples)
    return replace(layout, detail={**layout.detail, "slots": layout.detail["slots"][a - first : b - first], "first": a})


def _tile(f, page, k: int, layout: FileLayout, shape) -> np.ndarray:
    """Decode one strip or tile into (rows, columns, samples)."""
    offsets, counts = page
    f.seek(offsets[k])
    raw = f.read(counts[k])
    if layout.detail["deflate"]:
        raw = zlib.decompress(raw)
    dtype = np.dtype(layout.dtype)
    need = shape[0] * shape[1] * shape[2]
    tile = np.frombuffer(raw[: need * dtype.itemsize], dtype).reshape(shape)
    if layout.detail["predictor"] == 2:
        tile = np.cumsum(tile, axis=1, dtype=dtype)
    return tile


def read_box(layout: FileLayout, box: Box) -> np.ndarray:
    (z0, z1), (y0, y1), (x0, x1) = box
    d = layout.detail
    samples, (th, tw) = d["samples"], d["tile"]
    _, height, width = layout.shape
    across, down = -(-width // tw), -(-height // th)
    by_row = not d["deflate"] and d["predictor"] == 1 and samples == 1 and tw == width
    out = np.zeros((z1 - z0, y1 - y0, x1 - x0), np.dtype(layout.dtype))
    with open(layout.path, "rb") as f:
        for z in range(z0, z1):
            page, sample = d["slots"][z // samples - d.get("first", 0)], z % samples
            for ty in range(y0 // th, -(-y1 // th)):
                for tx in range(x0 // tw, -(-x1 // tw)):
                    k = ty * across + tx + (sample * across * down if d["planar"] else 0)
                    rows = th if tw != width or th * down == height else min(th, height - ty * th)
                    ya, yb = max(y0, ty * th), min(y1, ty * th + rows, height)
                    if by_row:
                        f.seek(page[0][k] + (ya - ty * th) * width * out.itemsize)
                        raw = f.read((yb - ya) * width * out.itemsize)
                        out[z - z0, ya - y0 : yb - y0] = np.frombuffer(raw, out.dtype).reshape(yb - ya, width)[:, x0:x1]
                        continue
                    tile = _tile(f, page, k, layout, (rows, tw, 1 if d["planar"] else samples))
                    xa, xb = max(x0, tx * tw), min(x1, tx * tw + tw, width)
                    part = tile[ya - ty * th : yb - ty * th, xa - tx * tw : xb - tx * tw, 0 if d["planar"] else sample]
                    out[z - z0, ya - y0 : yb - y0, xa - x0 : xb - x0] = part
    return out


def header(shape: Shape, dtype: str) -> tuple[bytes, int]:
    """Everything in front of the pixels, which follow in raster order.

    All page directories come first, so any task can write its own rows at
    ``offset + raster index * itemsize`` without knowing about the others.
    """
    z, y, x = shape
    kind = np.dtype(dtype)
    page = y * x * kind.itemsize
    big = z * (page + 400) + 4096 > 2**32
    text = b""
    if kind.name in IMAGEJ_DTYPES and not big:
        text = f"ImageJ=1.11a\nimages={z}\nslices={z}\n".encode() + b"\0"
    letter = {"u": 1, "b": 1, "i": 2, "f": 3}[kind.kind]
    start = 16 if big else 8
    slot, entry = (8, "<HHQQ") if big else (4, "<HHII")
    count = 11 if text else 10
    ifd = (8 + count * 20 + 8) if big else (2 + count * 12 + 4)
    text_at = start + z * ifd
    pixels = -(-(text_at + len(text)) // 16) * 16
    long = 16 if big else 4
    out = bytearray(struct.pack("<2sHHHQ", b"II", 43, 8, 0, start) if big else struct.pack("<2sHI", b"II", 42, start))
    for k in range(z):
        tags = [
            (WIDTH, 4, x), (HEIGHT, 4, y), (BITS, 3, kind.itemsize * 8), (COMPRESSION, 3, PLAIN), (PHOTOMETRIC, 3, 1),
            (OFFSETS, long, pixels + k * page), (SAMPLES, 3, 1), (ROWS, 4, y), (COUNTS, long, page), (FORMAT, 3, letter),
        ]
        body = [struct.pack(entry, tag, t, 1, value) for tag, t, value in tags]
        if text:
            body.insert(5, struct.pack(entry, DESCRIPTION, 2, len(text), text_at))
        following = start + (k + 1) * ifd if k + 1 < z else 0
        out += struct.pack("<Q" if big else "<H", count) + b"".join(body) + struct.pack("<Q" if big else "<I", following)
    out += text
    out += b"\0" * (pixels - len(out))
    return bytes(out), pixels
