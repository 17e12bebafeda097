"""Quality rules as a bitmask ledger.

Texts are measured once and every rule is evaluated once; the ledger keeps the
measurements and one bit per failed rule. A policy is a set of bits with a version.
Applying one, changing one or asking what a rule alone costs needs only the ledger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.workers import ready

BLANK = " \t\n\r\v\f"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint"

# Each rule: name and the SQL condition over the measurements under which a text fails it. A rule's place is its bit;
# new rules go to the end.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("repeated_lines", "n_lines >= 4 and 2 * n_dup_lines > n_lines"),
    ("symbols", "n_symbols > n_words"),
    ("long_words", "word_chars > 40 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    def mask(self, rules=RULES) -> int:
        places = {name: i for i, (name, _) in enumerate(rules)}
        return sum(1 << places[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
STANDARD = Policy("standard", tuple(name for name, _ in RULES))


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside a window of ``width`` words that occurs twice or more, its first occurrence included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    name = ids[:n]
    for step in range(1, width):
        following = ids[step : step + n]
        name = np.unique(name * len(seen) + following, return_inverse=True)[1]
    starts = np.flatnonzero(np.bincount(name)[name] > 1)
    if not starts.size:
        return 0
    edges = np.bincount(starts, minlength=len(words) + 1) - np.bincount(starts + width, minlength=len(words) + 1)
    return int(np.count_nonzero(np.cumsum(edges)))


def measures(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one whole text; null counts as empty."""
    text = text or ""
    words = text.encode("utf-8").split()
    lines = [line for line in text.split("\n") if line.strip(BLANK)]
    chars = len(text) - sum(map(text.count, BLANK))
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeated_words(words)


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """``key``, the measurements and ``failures``, a bit for each rule a text fails.

    One row a document, repeated and null keys included; other columns are not
    carried. Null and empty texts have no words and fail what that implies.
    Narrow: no shuffle.
    """
    ready(docs.sparkSession)
    names = [m.split()[0] for m in MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measures(t.as_py()) for t in batch.column(1)], dtype=np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in found.T]], names=["key", *names])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    measured = rows.mapInArrow(run, f"key {kind}, {MEASURES}")
    bits = " + ".join(f"if({condition}, {1 << i}L, 0L)" for i, (_, condition) in enumerate(rules))
    return measured.withColumn("failures", F.expr(bits)).withColumnRenamed("key", key)


def failed(mask: int) -> F.Column:
    return F.col("failures").bitwiseAND(F.lit(mask).cast("bigint")) != 0


def apply_policy(rows: DataFrame, policy: Policy, rules=RULES) -> DataFrame:
    """A ledger with ``kept`` under one policy and the policy's version."""
    return rows.withColumn("kept", ~failed(policy.mask(rules))).withColumn("policy", F.lit(policy.version))


def ablations(rows: DataFrame, policies: tuple[Policy, ...], rules=RULES) -> DataFrame:
    """For each policy and rule: documents that fail it, that fail it alone, and that stay without it.

    Documents are first counted by failure bits, so all else runs on at most
    2^rules rows whatever the corpus. Null failures cannot occur.
    """
    counted = rows.groupBy("failures").agg(F.count("*").alias("n"))
    table = [(p.version, p.mask(rules), name, 1 << i) for p in policies for i, (name, _) in enumerate(rules) if name in p.rules]
    if not table:
        raise ValueError("the policies name no rule")
    asked = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(m).cast("bigint").alias("mask"), F.lit(r).alias("rule"), F.lit(b).cast("bigint").alias("bit")) for p, m, r, b in table])
    met = counted.select("n", "failures", F.inline(asked))
    hit = F.col("failures").bitwiseAND(F.col("bit")) != 0
    alone = F.col("failures").bitwiseAND(F.col("mask")) == F.col("bit")
    stays = F.col("failures").bitwiseAND(F.col("mask")).bitwiseAND(F.bitwise_not("bit")) == 0
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return met.groupBy("policy", "rule").agg(count(hit).alias("fail"), count(alone).alias("fail_alone"), count(stays).alias("kept_without"))
