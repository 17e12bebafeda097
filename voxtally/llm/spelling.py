"""Spelling variants at edit distance one, by a dictionary of trie-node pairs.

The vocabulary is held as two tries, one over words and one over reversed words. A
word cut at a position is a pair of integers: the node of what stands before and the
reversed node of what stands behind. Leaving out one letter gives the pair
(before, behind the letter), inserting nothing gives (before, behind). Two words that
share a pair with a letter left out differ by a replacement there; a word with a letter
left out that shares the pair of a word without one differs from it by an insertion.
These are exactly the pairs of words one edit apart, so no distance is computed. All
words of one pair differ in one letter, so no group holds more than the alphabet
and one word more.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.workers import ready
from voxtally.session import cut_lineage, drop_written

# Fixed values of the task: letters, least letters, least occurrences, share of runs that lose a letter.
LOWERED = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))  # Latin-1, all but letters blank
LETTERS, OCCURRENCES, DROPPED = 5, 3, 97
STRONGER = 2  # a form occurs at least so many times as often
COUNTED = 1 << 18  # words that a task counts before it hands them on
PART_WORDS = 100_000
_PART, _INNER = 1 << 44, 1 << 43


def _count(counts: Counter[bytes], text: bytes, key: object, dropped: int) -> None:
    """Add the words of one text, in Latin-1; one distinct word in ``dropped`` loses a letter, chosen by key and word."""
    narrow = text if text.isascii() else text.decode("utf-8").encode("latin-1", "replace")  # one byte a code point, the rest is no letter
    words = narrow.translate(LOWERED).split()
    counts.update(words)
    if key is None or not dropped:
        return
    seed, crc = zlib.crc32(f"{key}:".encode()), zlib.crc32
    if text.isascii():
        changed = {w for w in set(words) if not crc(w, seed) % dropped}
    else:
        changed = {w for w in set(words) if not crc(w if w.isascii() else w.decode("latin-1").encode(), seed) % dropped}
    for word, n in Counter(filter(changed.__contains__, words)).items():
        at = crc(word.decode("latin-1").encode(), seed) % len(word)
        counts[word] -= n
        counts[word[:at] + word[at + 1 :]] += n


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = LETTERS, occurrences: int = OCCURRENCES, dropped: int = DROPPED) -> DataFrame:
    """``word, n`` of all words of at least ``letters`` letters with at least ``occurrences`` in whole texts.

    ``dropped`` 0 leaves all words as written; so does a null key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def closed() -> pa.RecordBatch:
            kept = {w.decode("latin-1"): n for w, n in counts.items() if n and len(w) >= letters}
            return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                _count(counts, value.as_py() or b"", name, dropped)
                if len(counts) >= COUNTED:
                    yield closed()
                    counts.clear()
        yield closed()

    found = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


def owned_paths(edges: list[tuple[int, str, str]]) -> dict[int, list[int]]:
    """For each part, in order, the parts that number the nodes on the path of its first word, as far as it shares them.

    A node that occurs in earlier parts lies on the path of this part's first
    word, and in the earliest of these parts on the path of its last word.
    """
    owners: dict[int, list[int]] = {}
    before: tuple[int, str, str] | None = None
    for part, first, last in edges:
        owners[part] = []
        if before is not None:
            earlier, head, tail = before
            carried = owners[earlier][: common(head, tail)]
            shared = common(tail, first)
            owners[part] = (carried + [earlier] * (shared - len(carried)))[:shared] if shared > len(carried) else carried[:shared]
        before = (part, first, last)
    return owners


def _numbered(keys: Iterator[str], part: int, last: str, owners: list[int]) -> Iterator[list[int]]:
    """Node numbers of all prefixes of the ascending words of one part, from the empty one on."""
    before, path, made = "", [0], 0
    for key in keys:
        shared = common(before, key)
        path = path[: shared + 1]
        known = common(key, last)
        for depth in range(shared + 1, len(key) + 1):
            if depth <= len(owners) and not before:  # only the first word meets nodes of other parts first
                path.append(owners[depth - 1] * _PART + depth)
            elif depth <= known:
                path.append(part * _PART + depth)
            else:
                made += 1
                path.append(part * _PART + _INNER + made)
        before = key
        yield list(path)


def trie_nodes(words: DataFrame) -> DataFrame:
    """``word, key, nodes``: the trie nodes of all prefixes of ``key``, a whole number for each, equal only for equal prefixes.

    Words are sorted into ranges, and each range numbers its nodes in one pass
    that keeps only the path of the word before. Nodes that ranges share are named
    after the last word of the first range that holds them; only these two words of
    each range reach the driver.
    """
    parts = words.count() // PART_WORDS + 1
    ranged = cut_lineage(words.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()), "ranged")
    edges = ranged.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("part").collect()
    last, owners = {r.part: r.last for r in edges}, owned_paths([(r.part, r.first, r.last) for r in edges])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, numbers = None, None
        feed: list[str] = []
        for batch in batches:
            places, keys, nodes = batch.column("part").to_pylist(), batch.column("key").to_pylist(), []
            for part, key in zip(places, keys, strict=True):
                if part != held:
                    held, feed = part, []
                    numbers = _numbered(iter(lambda f=feed: f.pop(), None), part, last[part], owners[part])
                feed.append(key)
                nodes.append(next(numbers))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("key"), pa.array(nodes, pa.list_(pa.int64()))], names=["word", "key", "nodes"])

    return ranged.repartition(parts, "part").sortWithinPartitions("part", "key").select("part", "word", "key").mapInArrow(run, "word bigint, key string, nodes array<bigint>")


def pair_postings(words: DataFrame) -> DataFrame:
    """``before, behind, word, n, gap, last``: the node pairs of every word ``word, text, n``.

    ``gap`` pairs leave nothing out. Of the pairs that leave out one letter of a run
    of equal ones, ``last`` marks the last, so that each shorter word is met once.
    """
    forward = trie_nodes(words.select("word", F.col("text").alias("key"))).select("word", "key", F.col("nodes").alias("ahead"))
    backward = trie_nodes(words.select("word", F.reverse("text").alias("key"))).select("word", F.reverse("nodes").alias("back"))
    both = forward.join(backward, "word").join(words.select("word", "n"), "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.array([len(k) for k in batch.column("key").to_pylist()], np.int64)
            ahead, back = (batch.column(c).flatten().to_numpy() for c in ("ahead", "back"))
            letters = np.frombuffer("".join(batch.column("key").to_pylist()).encode("utf-32-le"), np.uint32)
            ends = np.cumsum(size)
            final = np.append(letters[1:] != letters[:-1], True)[: letters.size]
            final[ends - 1] = True
            row = np.repeat(np.arange(size.size), size)
            at = np.arange(letters.size) + row  # node lists have one entry more than letters
            columns = [np.concatenate([ahead[at], ahead]), np.concatenate([back[at + 1], back])]
            who = np.concatenate([row, np.repeat(np.arange(size.size), size + 1)])
            gap = np.arange(who.size) >= letters.size
            columns += [batch.column(c).to_numpy()[who] for c in ("word", "n")]
            columns += [gap, np.concatenate([final, np.zeros(ahead.size, bool)])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["before", "behind", "word", "n", "gap", "last"])

    return both.select("word", "key", "n", "ahead", "back").mapInArrow(run, "before bigint, behind bigint, word bigint, n bigint, gap boolean, last boolean")


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best``: the number of words one edit away and, of these, the largest ``n`` and the first word with it."""
    groups = pair_postings(words).groupBy("before", "behind").agg(F.collect_list(F.struct("word", "n", "gap", "last")).alias("all")).filter("size(all) > 1")
    one = groups.select("all", F.explode("all").alias("m"))
    met = F.expr("filter(all, o -> o.word <> m.word and case when m.gap then o.last when o.gap then m.last else true end)")
    near = one.select(F.col("m.word").alias("word"), met.alias("near")).filter("size(near) > 0")
    best = F.array_max(F.transform("near", lambda o: F.struct(o["n"].alias("n"), (-o["word"]).alias("order"))))
    found = near.select("word", F.size("near").cast("bigint").alias("met"), best.alias("best"))
    return found.groupBy("word").agg(F.sum("met").alias("n_near"), F.max("best").alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root``: follow ``word, form`` to the end, in as many rounds as the length of the longest way has binary digits."""
    ways = cut_lineage(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "ways")
    while not ways.filter("moved").isEmpty():
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = ways.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        after = cut_lineage(after, "ways")
        drop_written(ways)
        ways = after
    return ways.select("word", "root")


def variants(counted: DataFrame, stronger: int = STRONGER) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a vocabulary ``word, n`` of distinct words.

    Near words differ by one inserted, deleted or replaced letter. The form of a word is its
    most frequent near word (ties: the first in code-point order) if that occurs at
    least ``stronger`` times as often, else null; the root is the last form in a row,
    or the word itself. Words of any length take part; null words do not; an empty
    vocabulary gives an empty table.
    """
    ready(counted.sparkSession)
    source = cut_lineage(counted.filter("word is not null").select("word", "n"), "vocabulary")
    parts = source.count() // PART_WORDS + 1
    ranged = source.repartitionByRange(parts, "word").sortWithinPartitions("word")
    words = cut_lineage(ranged.select(F.monotonically_increasing_id().alias("word"), F.col("word").alias("text"), "n"), "words")  # numbers rise with the words
    near = words.join(near_words(words), "word", "left")
    strong = F.col("best.n") >= F.col("n") * stronger
    told = near.select("word", "text", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(strong, -F.col("best.order")).alias("form"), F.when(strong, F.col("best.n")).alias("form_n"))
    told = cut_lineage(told, "near")
    roots = last_forms(told.filter("form is not null").select("word", "form"))
    names = words.select(F.col("word").alias("form"), F.col("text").alias("form_text"))
    ends = roots.join(words.select(F.col("word").alias("root"), F.col("text").alias("root_text")), "root").select("word", "root_text")
    every = told.join(names, "form", "left").join(ends, "word", "left")
    return every.select(
        F.col("text").alias("word"), F.col("form_text").alias("form"), F.coalesce("root_text", "text").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Variants of the words of whole texts. Null and empty texts have no words; repeated rows count again; other columns are not used."""
    ready(docs.sparkSession)
    return variants(vocabulary(docs, key, text))
