"""Grey PNG images of 8 or 16 bits, in both directions."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MAGIC = b"\x89PNG\r\n\x1a\n"
IMAGE_DDL = "path string, height int, width int, nChannels int, data binary"


def encode(image: np.ndarray) -> bytes:
    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    rows = b"".join(b"\0" + row.astype(image.dtype.newbyteorder(">")).tobytes() for row in image)
    head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8 * image.itemsize, 0, 0, 0, 0)
    return MAGIC + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def _paeth(left: int, up: int, corner: int) -> int:
    guess = left + up - corner
    return min((left, up, corner), key=lambda v: abs(guess - v))


def decode(raw: bytes) -> np.ndarray:
    at, packed = len(MAGIC), b""
    while at < len(raw):
        size, tag = struct.unpack(">I4s", raw[at : at + 8])
        if tag == b"IHDR":
            width, height, depth, colour, _, _, laced = struct.unpack(">IIBBBBB", raw[at + 8 : at + 21])
        elif tag == b"IDAT":
            packed += raw[at + 8 : at + 8 + size]
        at += 12 + size
    if colour or laced or depth not in (8, 16):
        raise ValueError(f"only plain grey PNG of 8 or 16 bits is read, not colour type {colour}, depth {depth}")
    step = depth // 8
    lines = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, 1 + width * step)
    above, out = np.zeros(width * step, np.uint8), np.empty((height, width * step), np.uint8)
    for y, line in enumerate(lines):
        row = line[1:].copy()
        if line[0] == 1:  # from the left neighbour
            row = np.cumsum(row.reshape(width, step), axis=0, dtype=np.uint8).reshape(-1)
        elif line[0] == 2:  # from the row above
            row += above
        elif line[0] in (3, 4):  # from both
            done, up = row.tolist(), above.tolist()
            for x in range(len(done)):
                left, corner = (done[x - step], up[x - step]) if x >= step else (0, 0)
                done[x] = (done[x] + ((left + up[x]) // 2 if line[0] == 3 else _paeth(left, up[x], corner))) & 255
            row = np.array(done, np.uint8)
        out[y] = above = row
    return out.view(f">u{step}").reshape(height, width).astype(f"<u{step}")


def decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, raw in zip(*(batch.column(c).to_pylist() for c in ("path", "content")), strict=True):
            image = decode(raw)
            row = [path, *image.shape, 1, image.tobytes()]
            types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=["path", "height", "width", "nChannels", "data"])
