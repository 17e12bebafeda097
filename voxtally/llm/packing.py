"""Best-fit decreasing packing of tokenised documents into sequences of a fixed length.

Best fit depends only on lengths, and there are no more lengths than tokens in a
sequence. So the packing itself is decided on the histogram of lengths: a segment
tree over remaining capacities finds the tightest open sequence for a length, and
whole runs of equal sequences are filled at once, exactly as placing the documents
one by one would. The plan's size follows the sequence length, not the corpus.
Documents then look up their place by their rank among equals.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtally.llm.workers import ready
from voxtally.session import cut_lineage

MAX_WORDS = 600_000  # so many tokenised words are remembered by a worker
LONG_WORD = 48  # words of more bytes are not remembered
TAIL = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # what may follow a word's last letter and is tokenised apart from it
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")  # a to z and the small letters of Latin-1
TOGETHER = 100  # words that are tokenised in one call


class CapacityTree:
    """Segment tree over capacities 0..limit: the smallest one at hand that is large enough."""

    def __init__(self, limit: int):
        self.size = 1 << limit.bit_length()
        self.filled = bytearray(2 * self.size)

    def mark(self, capacity: int, filled: bool) -> None:
        node = capacity + self.size
        self.filled[node] = filled
        while node > 1:
            node //= 2
            self.filled[node] = self.filled[2 * node] | self.filled[2 * node + 1]

    def tightest(self, need: int) -> int | None:
        node = need + self.size
        if self.filled[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.filled[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.filled[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


def best_fit(counts: dict[int, int], limit: int) -> np.ndarray:
    """Placements of best-fit decreasing for so many documents of each length.

    Rows of (length, first rank, documents, first sequence, documents per
    sequence, offset): documents of ``length`` from that rank on go, so many to
    a sequence and one after the other from ``offset``, into successive sequences.
    """
    tree, free, opened = CapacityTree(limit), defaultdict(list), 0
    placed = []
    for length in sorted(counts, reverse=True):
        rank, n = 0, counts[length]
        while rank < n:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, first = limit, opened
                sequences = -(-(n - rank) // (limit // length))
                opened += sequences
            else:
                first, sequences = free[capacity].pop()
            each = capacity // length
            full, rest = divmod(min(n - rank, sequences * each), each)
            for begin, many, items in ((first, full, each), (first + full, int(rest > 0), rest)):
                if many:
                    placed.append((length, rank, many * items, begin, items, limit - capacity))
                    rank += many * items
                    left = capacity - items * length
                    free[left].append((begin, many))
                    tree.mark(left, True)
            used = full + (rest > 0)
            if used < sequences:
                free[capacity].append((first + used, sequences - used))
            tree.mark(capacity, bool(free[capacity]))
    return np.array(placed, dtype=np.int64).reshape(-1, 6)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are parallel already
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    tokenizer, whole, plain = (Tokenizer.from_file(path) for _ in range(3))
    tokenizer.encode_special_tokens = plain.encode_special_tokens = True
    # Words of PLAIN letters pass normalising and splitting unchanged.
    plain.normalizer = normalizers.Sequence([])
    plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer, plain, {}, whole, [t.content for t in whole.get_added_tokens_decoder().values()]


def token_bytes(texts: list[str], path: str, special: bool = False) -> Iterator[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers.

    With ``special``, special tokens that are written out in a text get their own
    ids, as the library has it by default; such texts go through the untouched
    tokenizer as they are. Without it they are read as any other characters.

    The tokenizer lower-cases, drops white space and never joins across it, nor
    a letter with a mark after it. So lower-cased words between ASCII white space
    are tokenised once, marks after the last letter apart, and put together again.
    """
    tokenizer, plain, known, whole, literals = _tokenizer(path)
    marked_up = {i for i, t in enumerate(texts) if any(x in t for x in literals)} if special else set()
    split = [[] if i in marked_up else t.encode("utf-8").lower().split() for i, t in enumerate(texts)]
    if len(known) > MAX_WORDS:
        known.clear()
    fresh = set().union(*split).difference(known)
    stems = {w: stem for w in fresh if (stem := w.rstrip(TAIL)) is not w and stem[-1:].isalpha()}
    fresh = list(fresh.difference(stems).union(stems.values(), (w[len(stem) :] for w, stem in stems.items())).difference(known))
    for at in range(0, len(fresh), 20_000):
        some = fresh[at : at + 20_000]
        easy = {w for w in some if PLAIN.fullmatch(w)}
        known.update(_coded(plain, list(easy), "|"))
        known.update(_coded(tokenizer, [w for w in some if w not in easy], "\x01"))
    for word, stem in stems.items():
        known[word] = known[stem] + known[word[len(stem) :]]
    for i, words in enumerate(split):
        if i in marked_up:
            yield array("I", whole.encode(texts[i], add_special_tokens=False).ids).tobytes()
            continue
        yield b"".join(map(known.__getitem__, words))
    for word in [w for w in (*fresh, *stems) if len(w) > LONG_WORD]:
        del known[word]


def _coded(tokenizer, words: list[bytes], mark: str) -> Iterator[tuple[bytes, bytes]]:
    """Each word with its ids; many words go into one call, with ``mark`` between them. Words that have it go alone."""
    texts = [w.decode("utf-8") for w in words]
    odd = [i for i, t in enumerate(texts) if mark in t]
    even = [i for i, t in enumerate(texts) if mark not in t] if odd else range(len(texts))
    for i, coded in zip(odd, tokenizer.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False), strict=True):
        yield words[i], array("I", coded.ids).tobytes()
    (between,) = tokenizer.encode(mark, add_special_tokens=False).ids
    groups = [even[at : at + TOGETHER] for at in range(0, len(even), TOGETHER)]
    joined = [f" {mark} ".join([texts[i] for i in g]) for g in groups]
    for group, coded in zip(groups, tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
        ids = np.array(coded.ids, dtype="<u4")
        raw, first = ids.tobytes(), 0
        for i, end in zip(group, [*(4 * np.flatnonzero(ids == between)).tolist(), len(raw)], strict=True):
            yield words[i], raw[first:end]
            first = end + 4


def pieces(docs: DataFrame, path: str, limit: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text", ids: bool = False, special: bool = False) -> DataFrame:
    """Token pieces of every document, at most ``limit`` tokens each.

    A document is its ids and ``end_id``; only a longer one is cut. Null text
    counts as empty (one piece of one token); repeated or null keys stay as
    they are; ``special`` is that of :func:`token_bytes`. Columns: ``key``, piece, start, length, ids_crc32, the partition
    ``part`` that made the piece and its ``place`` among that partition's pieces
    of the same length; with ``ids`` also the ids themselves. Narrow: no shuffle.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    names = ["key", "piece", "start", "length", "ids_crc32", "part", "place"] + ["ids"] * ids
    end, width = np.array([end_id], dtype="<u4").tobytes(), 4 * limit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                source, table = [], []
                for row, coded in enumerate(token_bytes(batch.column(1).to_pylist(), path, special)):
                    coded += end
                    for number, begin in enumerate(range(0, len(coded), width)):
                        own = coded[begin : begin + width]
                        length = len(own) // 4
                        source.append(row)
                        table.append((number, begin // 4, length, zlib.crc32(own), part, seen[length], own))
                        seen[length] += 1
                values = list(zip(*table, strict=True))
                columns = [pa.array(v, pa.int32() if i in (0, 4) else pa.int64()) for i, v in enumerate(values[:6])]
                if ids:
                    columns.append(pa.array([np.frombuffer(v, "<u4").astype(np.int32) for v in values[6]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(source, pa.int64())), *columns], names=names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, place bigint" + ", ids array<int>" * ids
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def pack(table: DataFrame, limit: int = 2048) -> DataFrame:
    """Give every piece its ``sequence_id`` and ``offset`` (other columns stay).

    ``table`` is a written table as :func:`pieces` makes it. Ranks among equal
    lengths come from the counts of each partition, so a length that a third of
    all pieces share is never gathered anywhere. Pieces of equal length may take
    each other's places from run to run; the number of sequences is fixed. An
    empty table gives an empty one.
    """
    counts = table.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = cut_lineage(counts, "lengths")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `limit` rows
    plan = best_fit(totals, limit)
    plan = table.sparkSession.sparkContext.broadcast(plan[np.lexsort((plan[:, 1], plan[:, 0]))])
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = table.join(counts.select("part", "length", earlier.alias("earlier")), ["part", "length"])
    kept = [c for c in table.columns if c not in ("part", "place")]
    ranked = ranked.select(*kept, (F.col("earlier") + F.col("place")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, first, _, begin, each, offset = plan.value.T
        order = (lengths << 48) + first
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(order, (length << 48) + rank, side="right") - 1
            sequence, item = np.divmod(rank - first[at], each[at])
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(begin[at] + sequence), pa.array(offset[at] + item * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, limit: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text", ids: bool = False, special: bool = False) -> DataFrame:
    """Tokenise, cut and pack all documents; see :func:`pieces` and :func:`pack`."""
    return pack(cut_lineage(pieces(docs, path, limit, end_id, key, text, ids, special), "pieces"), limit)
