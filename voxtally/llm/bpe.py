"""Byte-level BPE by a lazily determinised transducer, with streaming decode.

The merge table is compiled, state by state and only where texts lead, into a
deterministic transducer over bytes. What makes it possible: every prefix of a
word has exactly one last token, and two neighbours are right exactly when
merging their joined bytes gives those two back. A state is the last settled
token and the bytes after it; tokens leave as soon as every start that a later
token could still take agrees on them, so the lookahead is bounded by the
longest tokens and a word of any length is encoded in linear time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.workers import ready

MAX_STATES = 400_000  # the transducer is rebuilt beyond that; results do not depend on it
MAX_WORDS = 600_000  # so many encoded words are remembered
LONG_WORD = 48  # words above so many characters are not remembered
DECODE_CHUNK = 8192  # tokens decoded at once


NEVER = 1 << 60
UNASKED = -2  # stands for a token before that no later check can ask for


class _Node:
    """The longest end of what was read that begins a longer token, and the lengths of all such ends, longest first."""

    __slots__ = ("text", "open", "arcs")

    def __init__(self, text: bytes, lengths: tuple[int, ...]):
        self.text, self.open = text, lengths
        self.arcs: dict[int, tuple[_Node, tuple[tuple[int, int], ...]]] = {}


class _State:
    """``last`` holds the last token of those prefixes of the unsettled bytes that a later token can build on."""

    __slots__ = ("prev", "last", "node", "next", "tail")

    def __init__(self, prev: int, last: tuple[int | None, ...], node: _Node):
        self.prev, self.last, self.node = prev, last, node
        self.next: dict[int, tuple[_State, tuple[int, ...]]] = {}
        self.tail: tuple[int, ...] | None = None


class Transducer:
    """Token ids of one word by the ranks of its merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.spelled = {i: t for t, i in ranks.items()}
        self.width = {i: len(t) for t, i in ranks.items()}
        self.open = {t[:k] for t in ranks for k in range(len(t))}
        self.root = _Node(b"", (0,))
        self.nodes = {b"": self.root}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self._restart()

    def _restart(self) -> None:
        self.start = _State(-1, (), self.root)
        self.states = {(-1, (), b""): self.start}

    def _merged(self, word: bytes, until: int = 1) -> list[int]:
        """Merging by definition, for short strings, down to ``until`` parts: lowest rank first, leftmost among equals."""
        rank = self.ranks.get
        parts = [word[i : i + 1] for i in range(len(word))]
        costs = [rank(word[i : i + 2], NEVER) for i in range(len(word) - 1)]
        while len(costs) >= until and (least := min(costs)) < NEVER:
            at = costs.index(least)
            parts[at] += parts.pop(at + 1)
            del costs[at]
            if at < len(costs):
                costs[at] = rank(parts[at] + parts[at + 1], NEVER)
            if at:
                costs[at - 1] = rank(parts[at - 1] + parts[at], NEVER)
        return [self.ranks[p] for p in parts]

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of ``token`` joins; None for one byte."""
        if token not in self.halves:
            self.halves[token] = tuple(self._merged(self.spelled[token], 2)) if self.width[token] > 1 else None
        return self.halves[token]

    def _apart(self, before: int, token: int) -> bool:
        """Whether no merge joins two tokens: merges next to their border are undone, the latest first.

        A pair at the border joins if its rank is below that of the merge that was
        undone last; at the same rank the one on the left comes first.
        """
        limit, spelled, rank = NEVER, self.spelled, self.ranks.get
        while rank(spelled[before] + spelled[token], NEVER) >= limit:
            left, right = self._split(before), self._split(token)
            if left and (before > token or not right):
                limit, before = before, left[1]
            elif right:
                limit, token = token + 1, right[0]
            else:
                return True
        return False

    def _follows(self, before: int, token: int) -> bool:
        """Whether ``token`` may stand after ``before`` (-1: at the start of a word)."""
        known = self.pairs.get((before, token))
        if known is None:
            if len(self.pairs) > 2 * MAX_STATES:
                self.pairs.clear()
            known = self._merged(self.spelled[token]) == [token] if before < 0 else self._follows(-1, token) and self._apart(before, token)
            self.pairs[before, token] = known
        return known

    def _arc(self, node: _Node, byte: int) -> tuple[_Node, tuple[tuple[int, int], ...]]:
        """The node after one more byte, and the tokens that end there with their lengths, longest first."""
        read = node.text + bytes((byte,))
        ends, lengths = [], []
        for length in node.open:
            ending = read[len(read) - length - 1 :]
            token = self.ranks.get(ending)
            if token is not None:
                ends.append((length + 1, token))
            if ending in self.open:
                lengths.append(length + 1)
        text = read[len(read) - lengths[0] :] if lengths else b""
        target = self.nodes.get(text)
        if target is None:
            target = self.nodes[text] = _Node(text, (*lengths, 0))
        node.arcs[byte] = arc = (target, tuple(ends))
        return arc

    def _step(self, state: _State, byte: int) -> tuple[_State, tuple[int, ...]]:
        node, ends = state.node.arcs.get(byte) or self._arc(state.node, byte)
        last, width, pairs = state.last, self.width, self.pairs
        size = len(last) + 1
        for length, token in ends:
            start = size - length
            before = last[start - 1] if start else state.prev
            known = pairs.get((before, token))
            if known or known is None and self._follows(before, token):
                break
        last = (*last, token)
        # Where the ways back from all starts that a later token can take have come together, tokens are settled.
        settled, kept = size - node.open[0], set()
        asked = settled
        for length in node.open[1:]:
            end = size - length
            while end != settled:
                if end > settled:
                    kept.add(end)
                    end -= width[last[end - 1]]
                else:
                    kept.add(settled)
                    settled -= width[last[settled - 1]]
        prev, out = state.prev, ()
        if settled:
            out = self._tokens(last, settled)
            prev = out[-1]
        if asked != settled:
            prev = UNASKED
        last = tuple([last[end - 1] if end in kept else None for end in range(settled + 1, size + 1)])
        key = (prev, last, node.text)
        target = self.states.get(key)
        if target is None:
            target = self.states[key] = _State(prev, last, node)
        state.next[byte] = step = (target, out)
        return step

    def _tokens(self, last: tuple[int, ...], end: int) -> tuple[int, ...]:
        """The tokens up to ``end``, walked from their last one."""
        out = []
        while end:
            out.append(last[end - 1])
            end -= self.width[out[-1]]
        return tuple(reversed(out))

    def encode(self, word: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(word)
        if whole is not None:
            return (whole,)
        if len(self.states) > MAX_STATES:
            self._restart()
        state, out = self.start, []
        for byte in word:
            step = state.next.get(byte) or self._step(state, byte)
            state, tokens = step
            out += tokens
        if state.tail is None:
            state.tail = self._tokens(state.last, len(state.last))
        return (*out, *state.tail)


class Utf8Stream:
    """UTF-8 decoding of bytes that arrive in pieces cut anywhere.

    Between pieces the state is the bytes of one character that has begun and
    not ended (three at most). Bytes that are no UTF-8 become U+FFFD.
    """

    def __init__(self) -> None:
        self.begun = b""

    def feed(self, piece: bytes) -> str:
        data = self.begun + piece
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                needed = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                cut -= back if needed > back and byte < 0xF8 else 0
                break
            if byte < 0x80:
                break
        self.begun = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """Encoding and decoding of whole texts. ``pattern`` cuts a text into words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        self.spelled = self.transducer.spelled
        self.words = regex.compile(pattern)
        self.known: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        known, ids = self.known, []
        for word in self.words.findall(text):
            tokens = known.get(word)
            if tokens is None:
                tokens = self.transducer.encode(word.encode("utf-8"))
                if len(word) <= LONG_WORD:
                    if len(known) >= MAX_WORDS:
                        known.clear()
                    known[word] = tokens
            ids += tokens
        return ids

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Texts of successive runs of tokens; joined they are the text."""
        stream, ids = Utf8Stream(), list(ids)
        for at in range(0, len(ids), DECODE_CHUNK):
            yield stream.feed(b"".join([self.spelled[i] for i in ids[at : at + DECODE_CHUNK]]))
        yield stream.close()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker; ``path`` must be readable on every node."""
    return Codec(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the token ids of each text (``ids``, array of int).

    A null or empty text gives no ids; rows are kept as they come, repeated or
    null keys included; other columns are not carried. Narrow: no shuffle.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            ids = pa.array([own.encode(t.as_py()) for t in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """``key`` and the text of ``ids``; null ids give an empty text, unknown ids an error."""
    ready(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            texts = ["".join(own.decode(ids.as_py() or ())) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    kind = encoded.schema[key].dataType.simpleString()
    rows = encoded.select(F.col(key).alias("key"), "ids")
    return rows.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text, decode its ids again, and keep digests of both.

    Encoding and decoding run in one pass, so ids never leave the worker.
    Columns: ``key``, n_tokens, ids_sha256 (decimal ids joined by one space),
    decoded_sha256 (UTF-8 of the decoded text). Edge cases as in :func:`encode`.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        decimal = {i: str(i) for i in own.spelled}
        for batch in batches:
            counts, digests, decoded = [], [], []
            for value in batch.column(1):
                ids = own.encode(value.as_py())
                counts.append(len(ids))
                digests.append(hashlib.sha256(" ".join([decimal[i] for i in ids]).encode()).hexdigest())
                back = hashlib.sha256()
                for run_text in own.decode(ids):
                    back.update(run_text.encode("utf-8"))
                decoded.append(back.hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
