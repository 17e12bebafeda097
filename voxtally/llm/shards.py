"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

How many rows of each input partition go to each shard is drawn first, with the
law that a uniform shuffle of the whole table would give and with exact totals.
Then each partition permutes its rows and deals them out by these counts, the rows
are exchanged, and every shard is permuted again. Only counts reach the driver.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.session import cut_lineage

NUMPY_LIMIT = 10**9  # numpy draws up to so many rows; beyond, the law is walked from its mode
ROWS_PER_TASK = 500_000  # rows of the slim table sorted by one task
BROADCAST_ROWS = 100_000  # the matrix is broadcast up to so many partitions, else joined by key


def hypergeometric(good: int, bad: int, draws: int, rng: np.random.Generator) -> int:
    """How many of ``draws`` rows, taken without replacement, are among the ``good`` ones."""
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws)) if draws else 0
    least, most = max(0, draws - bad), min(draws, good)
    mode = min(most, max(least, (draws + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    weight = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws))
    left = rng.random() - weight
    low = high = mode
    below = above = weight
    while left > 0 and (low > least or high < most):
        if high < most:
            above *= (good - high) * (draws - high) / ((high + 1) * (bad - draws + high + 1))
            high += 1
            left -= above
            if left <= 0:
                return high
        if low > least:
            below *= low * (bad - draws + low) / ((good - low + 1) * (draws - low + 1))
            low -= 1
            left -= below
            if left <= 0:
                return low
    return mode


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows sent from each partition to each shard; rows add up to ``counts``, columns to ``sizes``."""
    rng = np.random.default_rng(seed)
    free, matrix = list(sizes), []
    for count in counts:
        row = []
        for shard, size in enumerate(free):
            rest = sum(free[shard + 1 :])
            row.append(hypergeometric(size, rest, count - sum(row), rng))
        free = [f - r for f, r in zip(free, row, strict=True)]
        matrix.append(row)
    return matrix


def _looked_up(rows: DataFrame, table: list[tuple], schema: str, keys: list[str]) -> DataFrame:
    small = rows.sparkSession.createDataFrame(table, schema)
    return rows.join(F.broadcast(small) if len(table) <= BROADCAST_ROWS else small, keys)


def assign(rows: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 in each shard) to every row.

    Shard sizes differ by one row at most. The draw depends on the seed and on
    how the rows are partitioned, never on their values: repeated, null and hot
    keys are spread like all others. Keep the rows slim, they are exchanged
    whole. Columns are kept but for the names ``__part``, ``__row``, ``__place``.
    An empty table gives an empty one; fewer rows than shards leave shards empty.
    """
    row_bits = F.lit((1 << 33) - 1)
    numbered = rows.withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id())
    permuted = numbered.sortWithinPartitions(F.xxhash64(F.lit(seed), "__row"), "__row")
    permuted = cut_lineage(permuted.withColumn("__place", F.monotonically_increasing_id().bitwiseAND(row_bits)), "permuted")

    counts = sorted(permuted.groupBy("__part").count().collect())
    total = sum(n for _, n in counts)
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix([n for _, n in counts], sizes, seed)
    ends = [(part, np.cumsum(row).tolist()) for (part, _), row in zip(counts, matrix, strict=True)]
    dealt = _looked_up(permuted, ends, "__part int, __ends array<bigint>", ["__part"])
    dealt = dealt.withColumn("shard", F.expr("size(filter(__ends, e -> e <= __place))")).drop("__ends")

    key = F.xxhash64(F.lit(seed + 1), "__part", "__place")
    exchanged = dealt.withColumn("__key", key).repartitionByRange(total // ROWS_PER_TASK + shards, "shard", "__key", "__part", "__place")
    exchanged = exchanged.sortWithinPartitions("shard", "__key", "__part", "__place").drop("__key", "__part", "__place", "__row")
    exchanged = cut_lineage(
        exchanged.withColumn("__part", F.spark_partition_id()).withColumn("__place", F.monotonically_increasing_id().bitwiseAND(row_bits)),
        "exchanged",
    )
    shift, filled, before, last = [], [0] * shards, 0, None
    for part, shard, n in sorted(exchanged.groupBy("__part", "shard").count().collect()):
        before = before if part == last else 0
        shift.append((part, shard, filled[shard] - before))
        filled[shard] += n
        before, last = before + n, part
    placed = _looked_up(exchanged, shift, "__part int, shard int, __shift bigint", ["__part", "shard"])
    return placed.withColumn("slot", F.col("__place") + F.col("__shift")).select(*rows.columns, "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``size`` (UTF-8 bytes and 1), ``text_crc32``, ``shard`` and ``slot`` of every document; null text has no bytes."""
    content = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(
        F.col(key), (F.octet_length(content) + 1).cast("bigint").alias("size"), F.crc32(content.cast("binary")).alias("text_crc32")
    )
    return assign(slim, shards, seed)
