"""Zarr v2 directory stores: one readable box per chunk file."""

from __future__ import annotations

import gzip
import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa

from voxtally.schema import Shape
from voxtally.sources.layout import Box, FileLayout


def describe(path: str) -> FileLayout:
    """A flat array, or level 0 of a multiscale group."""
    if not os.path.exists(os.path.join(path, ".zarray")):
        path = os.path.join(path, "0")
    with open(os.path.join(path, ".zarray")) as f:
        head = json.load(f)
    codec = head.get("compressor")
    name = codec["id"] if codec else None
    if name not in (None, "zlib", "gzip", "zstd", "lz4", "blosc") or head.get("filters"):
        raise ValueError(f"{path}: Zarr codec {codec or head['filters']} is not supported")
    shape, grid = list(head["shape"]), list(head["chunks"])
    if len(shape) not in (2, 3):
        raise ValueError(f"{path}: expected a 2-D or 3-D array, got shape {shape}")
    detail = {
        "codec": name,
        "fill": head.get("fill_value") or 0,
        "order": head.get("order", "C"),
        "separator": head.get("dimension_separator", "."),
        "flat": len(shape) == 2,
    }
    lead = [1] * (3 - len(shape))
    return FileLayout(path, "zarr", tuple(lead + shape), head["dtype"], tuple(lead + grid), detail)


# Codec numbers in the header of a Blosc buffer (fixed values).
BLOSC_CODECS = {1: "lz4_raw", 2: "snappy", 3: "zlib", 4: "zstd"}
BLOSC_BLOCK = 256 * 1024


def _unpack(data: bytes, size: int, codec: str) -> bytes:
    if len(data) == size:
        return data
    if codec == "zlib":
        return zlib.decompress(data)
    return pa.Codec(codec).decompress(data, size).to_pybytes()


def blosc_decode(raw: bytes) -> bytes:
    """One Blosc 1 buffer: a header, the start of every block, and blocks of one stream or a stream per byte of a value."""
    _, _, flags, width, size, block, _ = struct.unpack("<BBBBIII", raw[:16])
    if flags & 2:  # stored as it is
        return raw[16 : 16 + size]
    codec = BLOSC_CODECS.get(flags >> 5)
    if codec is None or flags & 4:
        raise ValueError("Blosc buffers with BloscLZ or bit shuffling are not supported")
    count = -(-size // block)
    out = []
    for k, at in enumerate(struct.unpack(f"<{count}I", raw[16 : 16 + 4 * count])):
        length = min(block, size - k * block)
        split = not flags & 16 and width <= 16 and block // width >= 128 and length == block
        pieces = []
        for _ in range(width if split else 1):
            (packed,) = struct.unpack("<I", raw[at : at + 4])
            pieces.append(_unpack(raw[at + 4 : at + 4 + packed], length // (width if split else 1), codec))
            at += 4 + packed
        data = b"".join(pieces)
        if flags & 1 and width > 1:
            whole = length // width * width
            data = np.frombuffer(data[:whole], np.uint8).reshape(width, -1).T.tobytes() + data[whole:]
        out.append(data)
    return b"".join(out)


def blosc_encode(raw: bytes, width: int, codec: str) -> bytes:
    """A Blosc 1 buffer with shuffled bytes and one stream a block; ``codec`` is lz4 or zstd."""
    number, name = {"lz4": (1, "lz4_raw"), "zstd": (4, "zstd")}[codec]
    block = BLOSC_BLOCK // width * width
    at, blocks = 16 + 4 * -(-len(raw) // block), []
    starts = []
    for k in range(0, len(raw), block):
        data = raw[k : k + block]
        shuffled = np.frombuffer(data, np.uint8).reshape(-1, width).T.tobytes()
        packed = pa.Codec(name).compress(shuffled).to_pybytes()
        packed = packed if len(packed) < len(data) else shuffled
        starts.append(at)
        blocks.append(struct.pack("<I", len(packed)) + packed)
        at += len(blocks[-1])
    head = struct.pack("<BBBBIII", 2, 1, 1 | 16 | number << 5, width, len(raw), block, at)
    return head + struct.pack(f"<{len(starts)}I", *starts) + b"".join(blocks)


def decode(raw: bytes, codec: str | None) -> bytes:
    if codec == "blosc":
        return blosc_decode(raw)
    if codec == "lz4":
        return pa.Codec("lz4_raw").decompress(raw[4:], struct.unpack("<I", raw[:4])[0]).to_pybytes()
    if codec == "zlib":
        return zlib.decompress(raw)
    if codec == "gzip":
        return gzip.decompress(raw)
    if codec == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    return raw


def read_box(layout: FileLayout, box: Box) -> np.ndarray | None:
    """The part of one chunk inside the array; None where the chunk was never written."""
    d = layout.detail
    index = [a // g for (a, _), g in zip(box, layout.grid)][1 if d["flat"] else 0 :]
    path = os.path.join(layout.path, d["separator"].join(map(str, index)))
    size = tuple(b - a for a, b in box)
    if not os.path.exists(path):
        return np.full(size, d["fill"], np.dtype(layout.dtype)) if d["fill"] else None
    with open(path, "rb") as f:
        raw = decode(f.read(), d["codec"])
    chunk = np.frombuffer(raw, np.dtype(layout.dtype)).reshape(layout.grid, order=d["order"])
    inner = tuple(slice(a % g, a % g + n) for (a, _), g, n in zip(box, layout.grid, size))
    return chunk[inner]


# Compressors that can be written, as they are named in the metadata (fixed values).
COMPRESSORS = {
    "zlib": {"id": "zlib", "level": 1},
    "blosc-lz4": {"id": "blosc", "cname": "lz4", "clevel": 5, "shuffle": 1, "blocksize": 0},
    "blosc-zstd": {"id": "blosc", "cname": "zstd", "clevel": 5, "shuffle": 1, "blocksize": 0},
}


def metadata(shape: Shape, chunks: Shape, dtype: str, codec: str = "zlib") -> str:
    kind = np.dtype(dtype)
    body = {
        "zarr_format": 2,
        "shape": list(shape),
        "chunks": list(chunks),
        "dtype": kind.str if kind.itemsize == 1 else kind.newbyteorder("<").str,
        "compressor": COMPRESSORS[codec],
        "fill_value": False if kind.kind == "b" else 0,
        "order": "C",
        "filters": None,
    }
    return json.dumps(body, indent=4)


def differences(there: dict, wanted: dict) -> list[str]:
    """What keeps chunks that are written as ``wanted`` from being read by the metadata that is ``there``."""
    unlike = [k for k in ("shape", "chunks", "order", "filters") if there.get(k) != wanted[k]]
    if np.dtype(there["dtype"]) != np.dtype(wanted["dtype"]):
        unlike.append("dtype")
    if (there.get("compressor") or {}).get("id") != wanted["compressor"]["id"]:
        unlike.append("compressor")
    if (there.get("fill_value") or 0) != wanted["fill_value"]:
        unlike.append("fill_value")
    return unlike + ["dimension_separator"] * (there.get("dimension_separator", ".") != ".")


def encode(chunk: np.ndarray, codec: str = "zlib") -> bytes:
    if codec == "zlib":
        return zlib.compress(chunk.tobytes(), 1)
    return blosc_encode(chunk.tobytes(), chunk.itemsize, codec.removeprefix("blosc-"))


def multiscales(levels: int, factor: int) -> str:
    """OME-NGFF 0.4 metadata of a pyramid."""
    datasets = [
        {"path": str(k), "coordinateTransformations": [{"type": "scale", "scale": [factor**k] * 3}]} for k in range(levels)
    ]
    axes = [{"name": a, "type": "space"} for a in "zyx"]
    return json.dumps({"multiscales": [{"version": "0.4", "name": "image", "axes": axes, "datasets": datasets}]}, indent=4)
