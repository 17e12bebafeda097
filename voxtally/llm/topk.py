"""Exact top-k inner products by block-at-a-time pruning.

Vectors are packed into document-range blocks that carry the largest and the
smallest value of every term. For a query the summed term maxima bound every score
of a block. Each task takes a chunk of queries and a shelf of blocks, visits the
blocks of each query in falling order of their bounds, scores them through their
forward index, and stops once the bound is below the k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtally.llm.workers import ready
from voxtally.session import cut_lineage

BLOCK_ROWS = 1024
SHELF_BLOCKS = 16  # blocks that one task holds
CHUNK_ROWS = 4096  # queries that one task holds
EXACT = 1 << 53


def quantised(vectors: DataFrame, key: str = "vec_id", value: str = "embedding", scale: int = 1024) -> DataFrame:
    """``id`` and ``terms``, floor(scale * x) of each component.

    Rows with a null key, and vectors that are null, empty or hold a null or
    non-finite component, are left out.
    """
    whole = F.forall(F.col(value), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(key).isNotNull() & F.col(value).isNotNull() & (F.size(value) > 0)).filter(F.coalesce(whole, F.lit(False)))
    return rows.select(F.col(key).cast("bigint").alias("id"), F.transform(F.col(value), lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("terms"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def blocks(rows: DataFrame) -> DataFrame:
    """Forward-index blocks of neighbouring ids: ``width, block, ids, terms, top, bottom`` (values as int64 bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            widths = np.diff(batch.column("terms").offsets.to_numpy())
            for width in np.unique(widths).tolist():
                own = batch.filter(pa.array(widths == width))
                for at in range(0, own.num_rows, BLOCK_ROWS):
                    piece = own.slice(at, BLOCK_ROWS)
                    terms = _matrix(piece.column("terms"), width)
                    row = [width, part + made, piece.column("id").to_numpy().tobytes(), terms.tobytes(), terms.max(axis=0).tobytes(), terms.min(axis=0).tobytes()]
                    made += 1
                    yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["width", "block", "ids", "terms", "top", "bottom"])

    parts = rows.count() // (BLOCK_ROWS * SHELF_BLOCKS) + 1
    ranged = rows.repartitionByRange(parts, "id").sortWithinPartitions("id")
    return ranged.mapInArrow(run, "width bigint, block bigint, ids binary, terms binary, top binary, bottom binary")


def search_shelf(queries: tuple[np.ndarray, np.ndarray], shelf: list[tuple[np.ndarray, ...]], k: int) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], int]:
    """The k best (score falling, id rising) of each query among the blocks, and the blocks scored."""
    names, terms = queries
    top, bottom = (np.stack([b[i] for b in shelf]) for i in (2, 3))
    largest = max(abs(int(a.max(initial=0))) for a in (np.abs(terms), np.abs(top), np.abs(bottom)))
    kind = np.float64 if largest * largest * terms.shape[1] < EXACT else np.int64
    wide = terms.astype(kind)
    bounds = np.maximum(wide, 0) @ top.T.astype(kind) + np.minimum(wide, 0) @ bottom.T.astype(kind)
    order = np.argsort(-bounds, axis=1, kind="stable")
    best = [(np.empty(0, kind), np.empty(0, np.int64)) for _ in names]
    active, scored = np.arange(names.size), 0
    for step in range(len(shelf)):
        at = order[active, step]
        open_ = np.array([best[q][0].size < k or bounds[q, b] >= best[q][0][-1] for q, b in zip(active, at, strict=True)], dtype=bool)
        active, at = active[open_], at[open_]  # later blocks have lower bounds still
        if not active.size:
            break
        for block in np.unique(at).tolist():
            asked = active[at == block]
            ids = shelf[block][0]
            scores = wide[asked] @ shelf[block][1].T.astype(kind)
            scored += asked.size
            for q, row in zip(asked.tolist(), scores, strict=True):
                had, had_ids = best[q]
                good = (ids != names[q]) & (row >= had[-1] if had.size == k else True)
                both, both_ids = np.concatenate([had, row[good]]), np.concatenate([had_ids, ids[good]])
                first = np.lexsort((both_ids, -both))[:k]
                best[q] = both[first], both_ids[first]
    return [(int(n), s.astype(np.int64), i) for n, (s, i) in zip(names, best, strict=True)], scored


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k rows with the highest inner product with each query.

    ``rows`` and ``queries`` are ``id, terms`` of whole numbers. Ties go to the
    smaller id. A row with the query's own id is no candidate; vectors of another
    length are none either. Repeated rows are candidates of their own; of queries
    that repeat an id, the smallest vector asks. Every query meets every block
    by chunk and shelf, so no task grows with the table; each gives k rows a query.
    """
    spark = rows.sparkSession
    ready(spark)
    packed = cut_lineage(blocks(rows), "blocks")
    asked = queries.groupBy("id").agg(F.min("terms").alias("terms"))
    asked = cut_lineage(asked.withColumn("width", F.size("terms").cast("bigint")), "queries")
    chunks = asked.count() // CHUNK_ROWS + 1
    shelf = (F.shiftright("block", 32) * (1 << 20) + (F.col("block") % (1 << 32) / SHELF_BLOCKS).cast("bigint")).alias("shelf")
    shelved = packed.select("*", shelf)
    shelves = shelved.selectExpr("width + 0 as width", "shelf + 0 as shelf").distinct()
    left = asked.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks))).join(shelves, "width").select("width", "shelf", "chunk", "id", "terms")
    right = shelved.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))))

    def run(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        found = []
        if ours.num_rows and theirs.num_rows:
            width = theirs.column("width")[0].as_py()
            read = [[np.frombuffer(v.as_py(), np.int64) for v in theirs.column(c)] for c in ("ids", "terms", "top", "bottom")]
            held = [(i, t.reshape(-1, width), a, b) for i, t, a, b in zip(*read, strict=True)]
            table = ours.combine_chunks()
            terms = _matrix(table.column("terms").combine_chunks(), width)
            found, _ = search_shelf((table.column("id").to_numpy(), terms), held, k)
        sizes = [s.size for _, s, _ in found]
        ids = np.repeat(np.array([n for n, _, _ in found], dtype=np.int64), sizes)
        scores, names = (np.concatenate([np.empty(0, np.int64), *[f[i] for f in found]]) for i in (1, 2))
        return pa.table({"query_id": ids, "vec_id": names, "score": scores})

    keys = ["width", "shelf", "chunk"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
