"""Near-duplicate groups by SimHash, found in a grid over segment bit counts.

A fingerprint is mapped to the bit counts of its two-bit segments. Counts are
kept in unary (0, 1, 2 as 00, 01, 11), so the Manhattan distance of two such
vectors is the number of differing bits, and it never exceeds the Hamming
distance of the fingerprints. Within ``radius`` 3, one half of the segments is at
Manhattan distance 1 or 0: the range join looks in the own grid cell of each half
and the cells one step away, drops what the bound excludes, and compares the
fingerprints that are left exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.functions.boxes import smallest_linked
from voxtally.operators.graph import connected_components
from voxtally.llm.workers import ready
from voxtally.session import cut_lineage, fresh_name

SEED = 42
RADIUS = 3
CELL_ROWS = 1024  # fingerprints compared together; fuller cells are compared in pairs of such blocks
HASH_RUN = 1 << 16  # shingles counted at once
PARTS, PART_BITS = 24, 16  # of a wide fingerprint
WORDS = PARTS * PART_BITS // 64
WIDE_RADIUS = 96  # of 384 bits; at a Jaccard similarity of 0.8 the mean is 58 and the standard deviation 7
WIDE_ROWS = 50_000  # postings compared at once, if their buckets are no larger
CROWD = 64  # linked postings of one bucket that are not compared with each other again
_MIX = np.random.default_rng(SEED).integers(0, 1 << 63, (2, 1, WORDS), dtype=np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of the word shingles of one whole text."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(shingles), HASH_RUN):
        hashes = [xxhash.xxh64_intdigest(s, SEED) for s in shingles[at : at + HASH_RUN]]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``key`` and the fingerprint ``fp`` (BIGINT of its bits) of every row; null text counts as empty."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["key", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, fp bigint")


def unary(fp):
    """Bit counts 0, 1, 2 of the two-bit segments as 00, 01, 11 (numpy array of uint64)."""
    low = np.uint64(0x5555555555555555)
    down = fp >> np.uint64(1)
    return ((fp | down) & low) | ((fp & down & low) << np.uint64(1))


def grid_rows(nodes: DataFrame) -> DataFrame:
    """Postings ``half, cell, fp, own``: the own cells of each ``fp`` and those one step away.

    A cell is the counts of one half, and the order of the two bits where a count
    is 1, which has to agree in every segment that is the same in both
    fingerprints; so a cell is named by the half's 32 bits and a step changes the
    count of one segment by 1. Cells one step apart differ in parity: only
    fingerprints in even cells visit their neighbours, and every pair within one
    step still meets exactly there.
    """
    halves = F.array(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32))
    placed = nodes.select("fp", F.posexplode(halves).alias("half", "cell"))
    steps = F.expr("transform(sequence(0, 31), j -> cell ^ shiftleft(1L, j))")
    visited = F.when(F.bit_count("cell") % 2 == 0, steps).otherwise(F.array().cast("array<bigint>"))
    posted = placed.select("fp", "half", F.posexplode(F.concat(F.array("cell"), visited)).alias("step", "cell"))
    return posted.select("half", "cell", "fp", (F.col("step") == 0).alias("own"))


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Spanning links of each group of rows with the same key; groups come one after the other."""

    def group(fps: np.ndarray, own: np.ndarray) -> None:
        mine, counts = np.flatnonzero(own), unary(fps)
        a, b = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, mine.size, 256):
            some = mine[at : at + 256]
            i, j = np.nonzero(np.bitwise_count(counts[some, None] ^ counts[None, :]) <= radius)
            near = np.bitwise_count(fps[some[i]] ^ fps[j]) <= radius
            i, j = i[near], j[near]
            a, b = np.concatenate([a, some[i]]), np.concatenate([b, j])
            apart = a != b
            if apart.any():
                root = smallest_linked(fps.size, a[apart], b[apart])
                a = np.flatnonzero(root != np.arange(fps.size))
                b = root[a]
            else:
                a, b = a[:0], b[:0]
        if a.size:
            out.append((fps[a].view(np.int64), fps[b].view(np.int64)))

    names = ["half", "cell", "x", "y"]
    rest: pa.Table | None = None
    for batch in (*batches, None):
        table = rest if batch is None else pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if table is None or not table.num_rows:
            continue
        keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in names])
        heads = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
        ends = np.append(heads[1:], table.num_rows)
        done = heads.size if batch is None else heads.size - 1
        fps = table.column("fp").to_numpy().view(np.uint64)
        own = table.column("own").to_numpy(zero_copy_only=False)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for start, end in zip(heads[:done], ends[:done], strict=True):
            if end - start > 1:
                group(fps[start:end], own[start:end])
        rest = None if batch is None else table.slice(int(heads[-1]))
        if out:
            a, b = (np.concatenate(side) for side in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a, b`` that connect exactly the distinct ``fp`` within ``radius`` (at most 3) of each other.

    Each task gives a spanning forest of what it compares, so a crowd of copies
    yields as many links as it has members. A cell with more than ``CELL_ROWS``
    postings is dealt out as pairs of blocks; no posting is left out. Spark does not
    count the rows that an explode adds and would broadcast the postings, so the join
    asks for a merge.
    """
    if radius > RADIUS:
        raise ValueError("the two-half grid covers a radius of at most 3")
    posted = grid_rows(nodes)
    crowd = posted.groupBy("half", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / CELL_ROWS).cast("int")
    met = posted.join(crowd.hint("merge"), ["half", "cell"]).select(
        "half", "cell", "fp", "own", F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
    )
    pairs = met.select("half", "cell", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "fp", "own")
    keys = ["half", "cell", "x", "y"]
    return pairs.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda b: _links(b, radius), "a bigint, b bigint")


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """SimHash of ``PARTS`` times 16 bits, as 64-bit words, from the 64-bit hashes of distinct shingles."""
    ones = np.zeros(64 * WORDS, dtype=np.int64)
    for at in range(0, hashes.size, 4096):
        x = (hashes[at : at + 4096, None] ^ _MIX[0]) * (_MIX[1] * np.uint64(2) + np.uint64(1))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        ones += np.unpackbits(x.astype("<u8").view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > hashes.size, bitorder="little").view("<u8").astype(np.uint64)


def wide_cells(prints: np.ndarray) -> np.ndarray:
    """Grid cells of wide fingerprints, two for each part: one is dealt by the low byte of the part, one by the high byte.

    A cell is the number of the part and the byte, the byte it is dealt by and the
    other byte. Two fingerprints that differ in at most one bit of a part agree in
    one of its bytes: they meet in that bucket, in one cell or in cells one step apart.
    """
    own = prints.astype("<u8").view(np.uint8).reshape(len(prints), PARTS, 2).astype(np.int32)
    place = np.arange(2 * PARTS, dtype=np.int32).reshape(PARTS, 2) << 16
    return (place + (own << 8) + own[:, :, ::-1]).reshape(len(prints), 2 * PARTS)


def _pairs(source: np.ndarray, first: np.ndarray, count: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every ``source`` with each of the ``count`` rows from ``first`` on, some at a time."""
    some = count > 0
    source, first, count = source[some], first[some], count[some]
    ends = np.cumsum(count)
    begin = 0
    while begin < source.size:
        done = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most, side="right")))
        n = count[begin:end]
        offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(source[begin:end], n), np.repeat(first[begin:end], n) + offset
        begin = end


def _wide_forest(cell: np.ndarray, node: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of all nodes whose postings share a cell or are in cells one step apart; postings are sorted by cell."""
    counts = unary(prints)
    _, bucket = np.unique(cell >> 8, return_inverse=True)
    key = (bucket << 8) | (cell & 255)
    many = np.bincount(key, minlength=(int(bucket[-1]) + 1) << 8)
    first = np.cumsum(many) - many
    names, who = np.unique(node, return_inverse=True)
    root = np.arange(names.size)
    rows, steps = np.arange(cell.size), [0, *(1 << k for k in range(8))]
    a, b = [], []

    def compare(i: np.ndarray, j: np.ndarray) -> None:
        apart = root[who[i]] != root[who[j]]
        i, j = i[apart], j[apart]
        for values in (counts, prints):  # the Manhattan bound first, then the exact distance
            near = np.bitwise_count(values[i] ^ values[j]).sum(axis=1, dtype=np.int64) <= radius
            i, j = i[near], j[near]
        a.append(who[i])
        b.append(who[j])

    def joined() -> np.ndarray:
        x, y = np.concatenate([np.empty(0, np.int64), *a]), np.concatenate([np.empty(0, np.int64), *b])
        found = smallest_linked(names.size, x, y)
        own = np.flatnonzero(found != np.arange(found.size))
        a[:], b[:] = [own], [found[own]]
        return found

    for step in steps:  # one posting of each cell with all in its reach: this settles crowds
        has = np.flatnonzero(many[key ^ step])
        compare(has, first[key[has] ^ step])
    root = joined()
    group = bucket * names.size + root[who]
    _, at, n = np.unique(group, return_inverse=True, return_counts=True)
    size = n[at]
    largest = np.zeros(int(bucket[-1]) + 1, np.int64)
    np.maximum.at(largest, bucket, size)
    crowded = largest[bucket] > CROWD
    top = np.full(largest.size, -1)
    fits = crowded & (size == largest[bucket])
    np.maximum.at(top, bucket[fits], root[who[fits]])
    inside = crowded & (root[who] == top[bucket])
    plain, odd = rows[~crowded], rows[crowded & ~inside]
    for step in steps:
        goal = key[plain] ^ step
        up = goal > key[plain]
        begin = first[goal] if step else plain + 1
        count = np.where(up, many[goal], 0) if step else first[goal] + many[goal] - begin
        for i, j in _pairs(plain, begin, count):
            compare(i, j)
        goal = key[odd] ^ step
        for i, j in _pairs(odd, first[goal], many[goal]):
            once = inside[j] | (j > i)
            compare(i[once], j[once])
        if sum(x.size for x in a) > WIDE_ROWS:
            root = joined()
    joined()
    return names[a[0]], names[b[0]]


def wide_links(nodes: DataFrame, radius: int = WIDE_RADIUS) -> DataFrame:
    """Links ``a, b`` that connect the nodes with wide fingerprints within ``radius``, from ``node``, ``cells`` and ``w0``, ``w1`` and so on.

    The range join of :func:`links` over ``PARTS`` parts instead of two halves: a
    bucket's cells and those one step apart are compared inside one task, by the
    Manhattan bound on the counts and then exactly. Fingerprints at a distance below
    ``2 * PARTS`` always meet; those of texts at a Jaccard similarity of 0.8 fail to
    once in 2,300 pairs. A task gives a spanning forest, so a crowd yields as many
    links as it has postings, and what one posting of a cell has linked is not compared again.
    """
    words = [f"w{k}" for k in range(WORDS)]
    posted = nodes.select("node", *words, F.explode("cells").alias("cell"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        goal = WIDE_ROWS
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                if sum(x.num_rows for x in held) < goal:
                    continue
            if not held:
                continue
            table = pa.Table.from_batches(held)
            cell = table.column("cell").to_numpy()
            end = cell.size if batch is None else int(np.searchsorted(cell >> 8, cell[-1] >> 8))
            held = table.slice(end).combine_chunks().to_batches()
            goal = WIDE_ROWS if end else 2 * goal  # a bucket is kept whole
            if end:
                prints = np.stack([table.column(w).to_numpy()[:end].view(np.uint64) for w in words], axis=1)
                a, b = _wide_forest(cell[:end].astype(np.int64), table.column("node").to_numpy()[:end], prints, radius)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    dealt = posted.repartition(F.shiftright("cell", 8)).sortWithinPartitions("cell")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, radius: int = RADIUS) -> DataFrame:
    """Every row's ``key``, ``fp`` and the group it belongs to: ``root``, a fingerprint, and ``component_id``, its smallest key.

    Rows with equal fingerprints are one node, so copies cost nothing. Texts
    without words (null and empty ones) share fingerprint zero. Null keys never
    name a group unless it has no other; repeated keys stay repeated; other
    columns are not carried; an empty table gives an empty one.
    """
    prints = cut_lineage(fingerprints(docs, key, text, width), "prints")
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("key").alias("first")), "nodes")
    roots = connected_components(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    named = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(groups, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select(F.col("key").alias(key), "fp", "root", "component_id")


def hex_fingerprint(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, radius: int = RADIUS) -> DataFrame:
    """One row of each group, the one with the smallest key; all columns stay.

    Among repeated or only null keys one row is picked by its place in the table.
    """
    row = fresh_name(docs, "row")
    rows = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = near_duplicates(rows, row, text, width, radius).select(row, "root")
    order = F.struct(F.col(key).isNull(), F.col(key), F.col(row))
    best = rows.select(row, key).join(groups, row).groupBy("root").agg(F.min_by(row, order).alias(row)).select(row)
    return rows.join(best, row, "left_semi").select(*docs.columns)
