"""A set of ids kept in files, for lookups inside tasks."""

from __future__ import annotations

import contextlib
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voxtally.session import shared_folder


@dataclass(frozen=True)
class StoredIds:
    """Files of sorted 64-bit ids, each with its first and last one.

    A task maps the files that its values can be in and reads the pages that a
    binary search passes; neither the driver nor a task holds all ids.
    """

    parts: tuple[tuple[str, int, int], ...]

    def holds(self, data: np.ndarray) -> np.ndarray:
        """Which samples are one of the ids; a fraction or a value beyond 64 bits is none."""
        values, place = np.unique(data, return_inverse=True)
        if values.dtype.kind == "f":
            whole = (np.abs(values) < 2.0**63) & (values == np.trunc(values))
        else:
            whole = values <= np.iinfo(np.int64).max
        wanted = values[whole].astype(np.int64)
        among = np.zeros(wanted.size, bool)
        for path, first, last in self.parts:
            a, b = np.searchsorted(wanted, first), np.searchsorted(wanted, last, side="right")
            if a < b:
                stored = np.memmap(path, "<i8", "r")
                at = np.searchsorted(stored, wanted[a:b])
                among[a:b] |= stored[at] == wanted[a:b]
        found = np.zeros(values.size, bool)
        found[whole] = among
        return found[place].reshape(data.shape)


@contextlib.contextmanager
def stored_ids(ids: DataFrame) -> Iterator[StoredIds]:
    """Sort the BIGINT column ``id`` into files of the shared folder, for the time of the context; null ids are none."""
    folder = shared_folder(ids.sparkSession, "ids")
    os.makedirs(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, ends = os.path.join(folder, uuid.uuid4().hex), []
        with open(path, "wb") as f:
            for batch in batches:
                found = batch.column(0).to_numpy().astype("<i8", copy=False)
                if found.size:
                    f.write(found.tobytes())
                    ends = [*ends[:1], int(found[0]), int(found[-1])]
        if ends:
            yield pa.RecordBatch.from_pylist([{"path": path, "first": ends[0], "last": ends[-1]}])

    try:
        dealt = ids.select("id").filter("id is not null").repartitionByRange("id").sortWithinPartitions("id")
        parts = dealt.mapInArrow(write, "path string, first bigint, last bigint").collect()
        yield StoredIds(tuple((r["path"], r["first"], r["last"]) for r in parts))
    finally:
        shutil.rmtree(folder, ignore_errors=True)
