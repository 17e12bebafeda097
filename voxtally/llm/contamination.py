"""Benchmark passages in training texts through a distributed positional inverted index.

The index is a table of segments. A segment takes whole texts of a bounded number of
rows and stores for every term the sorted places where it stands; places run through
all texts of the segment, with a gap between two texts, so that one number is a posting.
A search reads every segment once, in the task that holds it. For each phrase it starts
from the postings of the phrase's rarest term in that segment, moved back by the term's
offset, and intersects them with the moved postings of the next rarest terms until all
have agreed: what is left are the exact places of the phrase. Postings of all terms
lie in one ascending array of (term, place) numbers, so one binary search intersects the
lists of all phrases at once. Phrases come in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.workers import ready
from voxtally.session import cut_lineage

WINDOW = 10  # words of a phrase
SEGMENT_WORDS, SEGMENT_ROWS = 1 << 19, 1 << 14  # words and texts after which a segment is closed; a longer text is one segment
BLOCK_PHRASES = 100_000  # phrases that one pass over the index takes
SEED_ROWS = 1 << 20  # places followed at once
GAP = 1 << 10  # free places between two texts, more than any phrase or distance
_TERM, _PLACE = 1 << 31, np.int64(1 << 31)
#: One byte for each: letters A-Z lower-cased; digits, a-z and bytes of other scripts as they are; the rest a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_NAMES = ["first", "keys", "starts", "lengths", "terms", "counts", "places"]


def words(text: bytes | None) -> list[bytes]:
    """Words of one whole text in UTF-8; null has none."""
    return (text or b"").translate(_FOLD).split()


def _segment(lengths: list[int], found: list[bytes]) -> list[pa.Array]:
    sizes = np.array(lengths, np.int64)
    starts = np.cumsum(sizes + GAP) - sizes - GAP
    coded = pa.array(found, pa.binary()).dictionary_encode()
    codes = coded.indices.to_numpy()
    place = np.arange(codes.size, dtype=np.int64) + np.repeat(np.arange(sizes.size, dtype=np.int64) * GAP, sizes)
    counts = np.bincount(codes, minlength=len(coded.dictionary))
    steps = np.diff(place[np.argsort(codes, kind="stable")], prepend=0)  # small numbers compress; the first of a term may be negative
    packed = [starts.tobytes(), sizes.tobytes(), _listed(coded.dictionary), counts.astype(np.int32).tobytes(), steps.astype(np.int32).tobytes()]
    return [p if isinstance(p, pa.Array) else pa.array([p]) for p in packed]


def _listed(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays([0, len(values)], values)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Segments of the positional index of whole texts, with all their terms; a null text has no postings but is listed.

    Texts are numbered ``first, first + 1, ...`` within a segment; the numbers differ
    from call to call, so write the table before reading it twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, keys, lengths, found = TaskContext.get().partitionId() << 40, [], [], []

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([first]), _listed(pa.concat_arrays(keys)), *_segment(lengths, found)], names=_NAMES)

        for batch in batches:
            for at, value in enumerate(batch.column(1).cast(pa.binary())):
                own = words(value.as_py())
                if lengths and (len(found) + len(own) > SEGMENT_WORDS or len(lengths) >= SEGMENT_ROWS):
                    yield closed()
                    first += len(lengths)
                    keys, lengths, found = [], [], []
                keys.append(batch.column(0).slice(at, 1))
                lengths.append(len(own))
                found += own
        if lengths:
            yield closed()

    kind = docs.schema[key].dataType.simpleString()
    ddl = f"first bigint, keys array<{kind}>, starts binary, lengths binary, terms array<binary>, counts binary, places binary"
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, ddl)


class Segment:
    """One segment with its postings as ascending numbers ``term * 2^31 + place``."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        def numbers(name: str, kind) -> np.ndarray:
            return np.frombuffer(batch.column(name)[at].as_py(), kind)

        self.first, self.starts = batch.column("first")[at].as_py(), numbers("starts", np.int64)
        counts = numbers("counts", np.int32)
        self.terms = batch.column("terms")[at].values
        self.ends = np.cumsum(counts, dtype=np.int64)
        self.counts = counts.astype(np.int64)
        self.keys = np.repeat(np.arange(counts.size, dtype=np.int64) * _TERM, counts) + np.cumsum(numbers("places", np.int32), dtype=np.int64)

    def codes(self, terms: pa.Array) -> np.ndarray:
        """Numbers of terms here, -1 for those without a posting."""
        return pc.fill_null(pc.index_in(terms, value_set=self.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1


def _rarest_first(segment: Segment, phrases: np.ndarray, coded: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases with all terms in the segment, and their terms and offsets from the rarest on; -1 ends a short phrase."""
    local = np.where(phrases >= 0, coded[phrases], -1)
    whole = np.flatnonzero((local >= 0).sum(axis=1) == (phrases >= 0).sum(axis=1))
    local = local[whole]
    often = np.where(local >= 0, segment.counts[local], np.iinfo(np.int64).max)
    order = np.argsort(often, axis=1, kind="stable")
    return whole, np.take_along_axis(local, order, axis=1), order


def _seeds(segment: Segment, terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrase and place of each posting of the first term, in bounded pieces."""
    if not terms.size:
        return
    sizes = segment.counts[terms]
    until = np.cumsum(sizes)
    for at in range(0, int(until[-1]), SEED_ROWS):
        flat = np.arange(at, min(at + SEED_ROWS, int(until[-1])))
        phrase = np.searchsorted(until, flat, side="right")
        posting = segment.ends[terms[phrase]] - (until[phrase] - flat)
        yield phrase, segment.keys[posting] % _PLACE


def exact_places(segment: Segment, phrases: np.ndarray, coded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase and first place of every occurrence. ``phrases`` are rows of term numbers, -1 behind the last; ``coded`` are these terms here."""
    whole, terms, offsets = _rarest_first(segment, phrases, coded)
    found = []
    for phrase, place in _seeds(segment, terms[:, 0]):
        place = place - offsets[phrase, 0]
        for step in range(1, phrases.shape[1]):
            wanted = terms[phrase, step]
            key = wanted * _PLACE + place + offsets[phrase, step]
            at = np.minimum(np.searchsorted(segment.keys, key), segment.keys.size - 1)
            stays = (wanted < 0) | ((segment.keys[at] == key) & (place >= 0))
            phrase, place = phrase[stays], place[stays]
            if not phrase.size:
                break
        found.append((whole[phrase], place))
    return tuple(np.concatenate([np.empty(0, np.int64), *side]) for side in (zip(*found, strict=True) if found else ((), ())))


def near_places(segment: Segment, phrases: np.ndarray, coded: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrase and place of each posting of its rarest term that has all its other terms within ``distance`` words, in any order."""
    whole, terms, _ = _rarest_first(segment, phrases, coded)
    found = []
    for phrase, place in _seeds(segment, terms[:, 0]):
        for step in range(1, phrases.shape[1]):
            wanted = terms[phrase, step]
            low = wanted * _PLACE + np.maximum(place - distance, 0)
            at = np.minimum(np.searchsorted(segment.keys, low), segment.keys.size - 1)
            stays = (wanted < 0) | ((segment.keys[at] >= low) & (segment.keys[at] <= wanted * _PLACE + place + distance))
            phrase, place = phrase[stays], place[stays]
        found.append((whole[phrase], place))
    return tuple(np.concatenate([np.empty(0, np.int64), *side]) for side in (zip(*found, strict=True) if found else ((), ())))


def phrases_of(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``phrase, words`` of every distinct phrase, and ``phrase, key`` of the items that hold it.

    Every ``window`` consecutive words are a phrase, a shorter text is one, a text without words has none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folded = [b" ".join(words(v.as_py())) for v in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(folded, pa.binary()).cast(pa.string())], names=["key", "words"])

    if window >= GAP:
        raise ValueError(f"a phrase has to have fewer than {GAP} words")
    kind = items.schema[key].dataType.simpleString()
    parts = items.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, words string")
    parts = parts.filter("words <> ''").select("key", F.split("words", " ").alias("parts"))
    spans = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("parts") - window + 1)), lambda i: F.array_join(F.slice("parts", i, window), " "))
    held = cut_lineage(parts.select("key", F.explode(spans).alias("words")).distinct(), "held")
    phrases = cut_lineage(held.select("words").distinct().select(F.monotonically_increasing_id().alias("phrase"), "words"), "phrases")
    return phrases, held.join(phrases, "words").select("phrase", "key")


def _blocks(phrases: DataFrame, rows: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Terms, phrases as term numbers and the number of each phrase, about ``rows`` phrases at a time."""
    blocks = phrases.count() // rows + 1
    for block in range(blocks):
        held = phrases.filter(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == block).select("phrase", "words").toArrow()
        if held.num_rows:
            split = [p.encode("utf-8").split(b" ") for p in held.column("words").to_pylist()]
            terms = sorted({t for p in split for t in p})
            number = {t: i for i, t in enumerate(terms)}
            table = np.full((len(split), max(map(len, split))), -1, np.int64)
            for i, p in enumerate(split):
                table[i, : len(p)] = [number[t] for t in p]
            yield pa.array(terms, pa.binary()), table, held.column("phrase").to_numpy()


def matches(index: DataFrame, phrases: DataFrame, distance: int | None = None, block: int = BLOCK_PHRASES) -> DataFrame:
    """``row, begins, ends, phrases``: for each text with a match its merged hit stretches (words, end exclusive) and the phrases found.

    Exact phrases without ``distance``; with it, all words of a phrase within so many
    words of its rarest one, and the stretch is that word. A text may come in more
    than one row, one for each block of phrases.
    """
    if distance is not None and distance >= GAP:
        raise ValueError(f"the distance has to be below {GAP} words")

    def search(terms: pa.Array, table: np.ndarray, names: np.ndarray):
        sizes = (table >= 0).sum(axis=1)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: list[tuple[int, list[int], list[int], list[int]]] = []
                for at in range(batch.num_rows):
                    segment = Segment(batch, at)
                    coded = segment.codes(terms)
                    phrase, place = exact_places(segment, table, coded) if distance is None else near_places(segment, table, coded, distance)
                    long = sizes[phrase] if distance is None else np.ones(phrase.size, np.int64)
                    order = np.argsort(place, kind="stable")
                    phrase, place, long = phrase[order], place[order], long[order]
                    owner = segment.owner(place)
                    for first, end in _runs(owner):
                        own = place[first:end] - segment.starts[owner[first]]
                        begins, ends = _merged(own, own + long[first:end])
                        out.append((segment.first + int(owner[first]), begins.tolist(), ends.tolist(), np.unique(names[phrase[first:end]]).tolist()))
                columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
                kinds = [pa.int64(), *[pa.list_(pa.int64())] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["row", "begins", "ends", "phrases"])

        return run

    ddl = "row bigint, begins array<bigint>, ends array<bigint>, phrases array<bigint>"
    found = None
    for piece in _blocks(phrases, block):
        some = index.select("first", "starts", "terms", "counts", "places").mapInArrow(search(*piece), ddl)
        found = some if found is None else found.unionByName(some)
    return index.sparkSession.createDataFrame([], ddl) if found is None else found


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    if not values.size:
        return iter(())
    heads = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return zip(heads.tolist(), np.append(heads[1:], values.size).tolist(), strict=True)


def _merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint stretches that cover the same words; ``begins`` ascend."""
    reach = np.maximum.accumulate(ends)
    heads = np.flatnonzero(np.concatenate([[True], begins[1:] > reach[:-1]]))
    return begins[heads], reach[np.append(heads[1:] - 1, reach.size - 1)]


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of hit words and the phrases of each text, over its rows of all blocks."""
    for batch in batches:
        hits, named = [], []
        for stretches in batch.column("found").to_pylist():
            pairs = np.array(sorted((b, e) for s in stretches for b, e in zip(s["begins"], s["ends"], strict=True)), np.int64)
            begins, ends = _merged(pairs[:, 0], pairs[:, 1])
            hits.append(int((ends - begins).sum()))
            named.append(sorted({p for s in stretches for p in s["phrases"]}))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(hits, pa.int64()), pa.array(named, pa.list_(pa.int64()))], names=["row", "n_hit", "phrases"])


def _listed_texts(index: DataFrame, key: str) -> DataFrame:
    """``row, key, n_words`` of every indexed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, keys, lengths in zip(batch.column("first").to_pylist(), batch.column("keys"), batch.column("lengths"), strict=True):
                sizes = np.frombuffer(lengths.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(first + np.arange(sizes.size)), keys.values, pa.array(sizes)], names=["row", "key", "n_words"])

    return index.select("first", "keys", "lengths").mapInArrow(run, f"row bigint, key {index.schema['keys'].dataType.elementType.simpleString()}, n_words bigint")


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, distance: int | None = None
) -> DataFrame:
    """``key, n_words, n_hit, n_items, item_ids, contaminated`` of every row of ``docs``.

    Words are lower-cased (A-Z) runs of ASCII letters, digits and all characters beyond
    ASCII. Every ``window`` consecutive words of an item are a phrase; a shorter item
    is one phrase, one without words (null and empty ones) none. A word inside any
    occurrence of a phrase is hit. ``item_ids`` are the items with a phrase that
    occurs, sorted as strings and joined by commas; repeated items count once, and an
    item with a null key hits words but is not listed. Texts of any length are read
    whole; repeated documents give a row each, null texts have no words, null keys
    stay. Empty tables give no rows, or rows without a hit; other columns are not
    carried. With ``distance`` the hits are those of :func:`matches`.
    """
    ready(docs.sparkSession)
    index = cut_lineage(build_index(docs, key, text), "index")
    phrases, members = phrases_of(items, item, item_text, window)
    found = matches(index, phrases, distance).groupBy("row").agg(F.collect_list(F.struct("begins", "ends", "phrases")).alias("found"))
    hits = cut_lineage(found.mapInArrow(_covered, "row bigint, n_hit bigint, phrases array<bigint>"), "hits")
    # Copies share their set of phrases, so the item list is put together once for each distinct set.
    sets = cut_lineage(hits.select("phrases").distinct().select("phrases", F.monotonically_increasing_id().alias("set")), "sets")
    named = sets.select("set", F.explode("phrases").alias("phrase")).join(members, "phrase").select("set", F.col("key").cast("string").alias("name")).distinct()
    listed = named.groupBy("set").agg(F.array_sort(F.collect_set("name")).alias("names"))
    listed = listed.join(sets, "set").select("phrases", F.size("names").cast("bigint").alias("n_items"), F.array_join("names", ",").alias("item_ids"))
    told = hits.join(listed, "phrases").select("row", "n_hit", "n_items", "item_ids")
    every, none = _listed_texts(index, key).join(told, "row", "left"), F.lit(0).cast("bigint")
    return every.select(
        F.col("key").alias(key), "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("item_ids", F.lit("")).alias("item_ids"), F.col("n_hit").isNotNull().alias("contaminated"),
    )
