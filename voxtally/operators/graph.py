"""Connected components of an edge table, for graphs of any size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.functions.boxes import smallest_linked
from voxtally.session import cut_lineage, drop_written

# Edges contracted together inside a task; it bounds memory and does not touch the result.
CONTRACT_ROWS = 2_000_000


def _forest(hi: np.ndarray, lo: np.ndarray) -> pa.RecordBatch:
    """The same connections with one edge per node, to the smallest node it reaches."""
    nodes, at = np.unique(np.concatenate([hi, lo]), return_inverse=True)
    roots = nodes[smallest_linked(nodes.size, at[: hi.size], at[hi.size :])]
    apart = nodes != roots
    return pa.RecordBatch.from_arrays([pa.array(nodes[apart]), pa.array(roots[apart])], names=["hi", "lo"])


def _contract(edges: DataFrame) -> DataFrame:
    """Replace the edges of each partition by a spanning forest, without a shuffle."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("hi", "lo")])
            rows += batch.num_rows
            if rows >= CONTRACT_ROWS:
                yield _forest(*np.concatenate(held, axis=1))
                held, rows = [], 0
        if rows:
            yield _forest(*np.concatenate(held, axis=1))

    return edges.mapInArrow(contract, "hi bigint, lo bigint")


def _star_step(edges: DataFrame, node: str, out_hi, out_lo) -> DataFrame:
    """Join every edge with the smallest neighbour of ``node`` and rewrite it.

    Smallest neighbours come from a pre-aggregated group-by and are unique, so
    adaptive execution can split the edges of a crowded node.
    """
    lowest = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("lowest"))
    joined = edges.withColumn("node", F.col(node)).join(lowest, "node", "left")
    return joined.select(out_hi.alias("hi"), out_lo.alias("lo")).filter("hi <> lo").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most and none of these has one itself."""
    forked = edges.groupBy("hi").count().filter("count > 1").select("hi")
    chained = edges.select(F.col("lo").alias("hi")).join(edges.select("hi"), "hi", "left_semi")
    return forked.unionByName(chained).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges`` has BIGINT columns ``a`` and ``b``. Partitions are contracted on
    their own first; then the alternating large-star / small-star method turns
    the graph into stars around the smallest node of each component. Every round
    is two group-bys and two joins on evenly sized rows, and is written out so
    that plans stay short and losses stay cheap. Rounds end when all are stars.
    """
    table = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo")
    table = cut_lineage(_contract(table).distinct(), "edges")
    while not _are_stars(table):
        large = _star_step(table, "lo", F.col("hi"), F.coalesce("lowest", "lo"))
        moved = F.when(F.col("lo") != F.col("lowest"), F.col("lo")).otherwise(F.col("hi"))
        after = cut_lineage(_star_step(large, "hi", moved, F.col("lowest")), "edges")
        drop_written(table)
        table = after
    roots = table.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return table.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
