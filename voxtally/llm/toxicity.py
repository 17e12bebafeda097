"""Toxicity by a subsequence-kernel SVM with Nyström landmarks.

Two words are alike by the letter triples they share in order, gaps allowed and
discounted, so insults with inserted or separated letters stay close to the plain
ones. A sentence is the sum of its words under that kernel. Landmark words, found
by contrast between labelled texts, span the Nyström space in which a linear SVM is
trained on labelled sentences; there a sentence's margin is a sum of one number a
word, which is computed once for each distinct word. The margins of a text's worst
sentences give its calibrated score.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.workers import ready
from voxtally.session import fresh_name

SAMPLE = 1500  # labelled texts of each class that the model is fitted on, at most
SENTENCES = 60_000  # sentences of each class used in the fit, at most
LANDMARKS = 128
SPAN = 5  # letters over which a triple may stretch
WHOLE = 64  # letters of a word that is compared as one; longer runs of letters are cut
WINDOWS = ((6, 1), (8, 2), (12, 3), (16, 4))  # letters of the pieces of a long run, and of the way from one to the next
DECAY = 0.6  # weight of a triple for each letter of its stretch
LENGTH = 30  # a sentence without a full stop ends after so many words
MAX_WORDS = 300_000  # words remembered by a worker
TOGETHER = 4_000  # words compared with the landmarks at once
THRESHOLD = 0.7
SURPRISE = 20.0  # log-likelihood ratio from which a word marks the sentences of toxic texts
LETTERS = re.compile(r"[^\W\d_]+")
_END, _LONE = 1e3, 1e6  # marks added to a word's number: ends a sentence, is a single letter


def letters(chunk: str) -> str:
    """The letters of one blank-separated piece of lower-case text, whatever stands between them."""
    return chunk if chunk.isalpha() else "".join(LETTERS.findall(chunk))


def windows(word: str) -> Iterator[tuple[int, str]]:
    """A word, or a run of too many letters as overlapping pieces of several lengths, each of which covers it to its end; with their places."""
    if len(word) <= WHOLE:
        yield 0, word
    else:
        yield from ((at, word[at : at + width]) for width, step in WINDOWS for at in range(0, len(word) - width + step, step))


def triples(words: list[str], wanted: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gapped letter triples of many words: word number, code and weight of each, in word order.

    The start of a word counts as a letter. Weights are scaled by word, so that
    words of any length compare. ``wanted`` names the places of the codes to return.
    """
    gap = "\0" * (SPAN - 1)
    flat = np.frombuffer((gap.join(["^" + w for w in words]) + gap).encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = flat > 0
    owner = np.cumsum(flat == ord("^")) - 1
    first, n = flat[: 1 - SPAN], flat.size + 1 - SPAN
    parts = []
    for j in range(1, SPAN - 1):
        for k in range(j + 1, SPAN):
            at = np.flatnonzero(letter[:n] & letter[j : n + j] & letter[k : n + k])
            parts.append((owner[at], (first[at] << 42) | (flat[at + j] << 21) | flat[at + k], np.full(at.size, DECAY**k)))
    owners, codes, weights = (np.concatenate(x) for x in zip(*parts, strict=True))
    scale = np.sqrt(np.bincount(owners, weights**2, len(words)))
    if wanted:
        kept = wanted(codes)
        owners, codes, weights = owners[kept], codes[kept], weights[kept]
    order = np.argsort(owners, kind="stable")
    return owners[order], codes[order], (weights / scale[owners])[order]


@dataclass
class Model:
    """Landmark triples (``codes``, ``table``), the SVM in landmark terms (``alpha``, ``bias``) and the calibration."""

    codes: np.ndarray
    table: np.ndarray
    alpha: np.ndarray
    bias: float
    weights: np.ndarray
    words: dict[str, float] = field(default_factory=dict)
    known: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        self.slots = np.zeros(1 << 16, dtype=bool)
        self.slots[self._slot(self.codes)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)

    def _marked(self, codes: np.ndarray) -> np.ndarray:
        """The places of the codes that landmarks have."""
        maybe = np.flatnonzero(self.slots[self._slot(codes)])
        at = np.minimum(np.searchsorted(self.codes, codes[maybe]), self.codes.size - 1)
        return maybe[self.codes[at] == codes[maybe]]

    def likeness(self, words: list[str]) -> np.ndarray:
        """Kernel of each word with every landmark; cubed, so that only close words count."""
        found = np.zeros((len(words), self.table.shape[1]), dtype=np.float32)
        for at in range(0, len(words) if self.codes.size else 0, TOGETHER):
            self._add_likeness(words[at : at + TOGETHER], found[at : at + TOGETHER])
        return found

    def worst(self, word: str) -> dict[int, float]:
        """The largest number of the windows of a word in each stretch of as many letters as a sentence has words."""
        found: dict[int, float] = {}
        pieces = windows(word)
        while some := list(islice(pieces, TOGETHER)):
            for (at, _), value in zip(some, (self.likeness([w for _, w in some]) @ self.alpha).tolist(), strict=True):
                found[at // LENGTH] = max(value, found.get(at // LENGTH, value))
        return found

    def _add_likeness(self, words: list[str], found: np.ndarray) -> None:
        owners, codes, weights = triples(words, self._marked)
        at = np.searchsorted(self.codes, codes)
        weights = weights[:, None].astype(np.float32)
        for begin in range(0, codes.size, 8_000):
            some = slice(begin, begin + 8_000)
            starts = np.flatnonzero(np.concatenate([[True], np.diff(owners[some]) > 0]))
            found[owners[some][starts]] += np.add.reduceat(weights[some] * self.table[at[some]], starts)
        own = np.unique(owners)
        near = found[own]
        found[own] = near * near * near

    def learn(self, chunks: set[str]) -> None:
        """Have the numbers of all pieces of some texts at hand. Words are remembered by their letters, and compared once."""
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        some = list(chunks)
        read = [letters(c) for c in some]
        fresh = list(set(read).difference(self.words))
        for at in range(0, len(fresh), 20_000):
            words = fresh[at : at + 20_000]
            values = self.likeness([w if len(w) <= WHOLE else "" for w in words]) @ self.alpha
            size = np.array([len(w) for w in words])
            for i in np.flatnonzero(size > WHOLE).tolist():
                values[i] = max(self.worst(words[i]).values())
            values = np.where(size > 2, values, 0.0) + _LONE * (size == 1)
            self.words.update(zip(words, values.tolist(), strict=True))
        values = np.array([self.words[w] for w in read]) + _END * np.array([c[-1] in ".!?" for c in some])
        self.known = dict(zip(some, values.tolist(), strict=True))

    def margins(self, chunks: list[str]) -> np.ndarray:
        """Margins of the sentences of a whole text, given as its learned blank-separated pieces."""
        if not chunks:
            return np.empty(0)
        known = self.known
        values = np.array([known[c] for c in chunks])
        lone = values > _LONE / 2
        values -= _LONE * lone
        ends = values > _END / 2
        values -= _END * ends
        if lone.any():  # letters written apart are also read as the word they spell
            edges = np.flatnonzero(np.diff(np.concatenate([[0], lone, [0]])))
            for start, stop in edges.reshape(-1, 2).tolist():
                if stop - start > 2:
                    for at, value in self.worst("".join(map(letters, chunks[start:stop]))).items():
                        values[start + at * LENGTH] += value
        ends[LENGTH - 1 :: LENGTH] = True
        starts = np.concatenate([[0], np.flatnonzero(ends[:-1]) + 1])
        return np.add.reduceat(values, starts) + self.bias

    def features(self, texts: list[str | None]) -> np.ndarray:
        split = [(t or "").lower().split() for t in texts]
        self.learn({c for chunks in split for c in chunks})
        return np.array([pooled(self.margins(chunks)) for chunks in split]).reshape(-1, 6)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """0 to 1 for each whole text."""
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights, -30, 30)))


def pooled(margins: np.ndarray) -> np.ndarray:
    """Features of a text: its three worst sentences, how many are on the wrong side, and its length."""
    worst = np.full(3, -2.0)
    top = np.sort(margins)[::-1][:3]
    worst[: top.size] = top
    return np.array([1.0, *np.clip(worst, -2, 2), math.log1p(np.count_nonzero(margins > 0)), math.log1p(margins.size) / 5])


def _sentences(text: str) -> list[list[str]]:
    found = [own for s in re.split(r"[.!?]\s", text.lower()) if (own := [sys.intern(w) for c in s.split() if len(w := letters(c)) > 2])]
    return [s[i : i + LENGTH] for s in found for i in range(0, len(s), LENGTH)]


def _surprise(a: int, b: int, n_a: int, n_b: int) -> float:
    """Log-likelihood ratio of a word being in ``a`` of ``n_a`` toxic and ``b`` of ``n_b`` other texts; 0 if it is not more frequent there."""
    share = (a + b) / (n_a + n_b)
    if a / n_a <= share:
        return 0.0
    return 2 * (a * math.log(a / (n_a * share)) + (b * math.log(b / (n_b * share)) if b else 0.0))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 40) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w -= np.linalg.solve(hessian, x.T @ (p - y) + ridge * w)
    return w


def _svm(x: np.ndarray, y: np.ndarray, cost: float = 0.3, steps: int = 25) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    y, w = y.astype(x.dtype), np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(steps):
        inside = y * (x @ w.astype(x.dtype)) < 1
        a = x[inside]
        square, side = (a.T @ a).astype(np.float64), (a.T @ y[inside]).astype(np.float64)
        w = np.linalg.solve(ridge + cost * square, cost * side)
    return w[:-1], float(w[-1])


def _mapped(model: Model, space: np.ndarray, sentences: list[list[str]]) -> np.ndarray:
    """Sentences in the Nyström space: the sums of their words, some distinct words at a time."""
    place: dict[str, int] = {}
    word = np.array([place.setdefault(w, len(place)) for s in sentences for w in s], dtype=np.int32)
    owner = np.repeat(np.arange(len(sentences), dtype=np.int32), [len(s) for s in sentences])
    order = np.argsort(word, kind="stable")
    word, owner, words = word[order], owner[order], list(place)
    found = np.zeros((len(sentences), space.shape[1]), np.float32)
    for at in range(0, len(words), TOGETHER):
        own = slice(*np.searchsorted(word, (at, at + TOGETHER)))
        some = model.likeness(words[at : at + TOGETHER]) @ space
        for begin in range(own.start, own.stop, 20_000):
            part = slice(begin, min(begin + 20_000, own.stop))
            np.add.at(found, owner[part], some[word[part] - at])
    return found


def fit(texts: list[str], toxic: list[int], prior: float | None = None, seed: int = 0) -> Model:
    """Train on labelled texts. ``prior``: the share of toxic texts to calibrate for, their share here if None.

    Without texts of both classes the model scores everything 0 or, if all are toxic, 1.
    """
    y = np.array(toxic, dtype=int)
    if y.size == 0 or y.min() == y.max():
        weights = np.array([30.0 if y.size and y[0] else -30.0, 0, 0, 0, 0, 0])
        return Model(np.empty(0, np.int64), np.zeros((0, 1)), np.zeros(1), 0.0, weights)
    rng = np.random.default_rng(seed)
    split = [_sentences(t) for t in texts]
    bad, good = Counter(), Counter()
    for sentences, label in zip(split, toxic, strict=True):
        (bad if label else good).update({w for s in sentences for w in s})
    n_bad, n_good = int(y.sum()), int((1 - y).sum())
    seeds = {w: g for w, a in bad.items() if (g := _surprise(a, good[w], n_bad, n_good)) > SURPRISE}
    marks = sorted(seeds, key=lambda w: (-seeds[w], w))[: LANDMARKS * 3 // 4]
    marks += [w for w, _ in good.most_common(LANDMARKS * 4) if w not in seeds][: LANDMARKS - len(marks)]
    del bad, good
    owners, found, weights = triples([w[:64] for w in marks])
    codes, at = np.unique(found, return_inverse=True)
    table = np.zeros((codes.size, len(marks)))
    np.add.at(table, (at, owners), weights)
    model = Model(codes, table.astype(np.float32), np.zeros(len(marks)), 0.0, np.zeros(6))

    values, vectors = np.linalg.eigh((table.T @ table) ** 3)
    keep = values > 1e-6
    space = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)
    lexicon = set(seeds)
    # In a toxic text only some sentences are: those with a contrasting word stand for it.
    positive = [s for sentences, label in zip(split, toxic, strict=True) if label for s in sentences if lexicon & set(s)]
    negative = [s for sentences, label in zip(split, toxic, strict=True) if not label for s in sentences]
    chosen = []
    for some in (positive, negative):
        pick = rng.permutation(len(some))[:SENTENCES] if len(some) > SENTENCES else range(len(some))
        chosen.append([some[i] for i in pick])
    if chosen[0] and chosen[1]:
        x = _mapped(model, space, chosen[0] + chosen[1])
        v, model.bias = _svm(x, np.repeat([1.0, -1.0], [len(c) for c in chosen]))
        model.alpha = space @ v
    del positive, negative, chosen, split
    parts = []
    for at in range(0, len(texts), 256):
        parts.append(model.features(texts[at : at + 256]))
        model.words.clear()
    features = np.concatenate(parts)
    model.weights = _logistic(features, y.astype(float), 1.0)
    if prior is not None and 0 < prior < 1:
        share = y.mean()
        model.weights[0] += math.log(prior / (1 - prior)) - math.log(share / (1 - share))
    model.words, model.known = {}, {}
    return model


def held_out(key: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` texts of each class, chosen by a hash among labelled rows that are not held out.

    Only the chosen keys, so many at most, are broadcast to find the texts.
    Labels other than 0 and 1 and rows without text are not used.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & ~held_out(key)).groupBy(key).agg(F.max(label).alias(label))
    counts = {r[0]: r[1] for r in usable.groupBy(label).count().collect()}
    order = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(1 << 20)) / float(1 << 20)
    picked = [usable.filter((F.col(label) == v) & (order < 1.1 * sample / max(1, counts.get(v, 0)))).limit(sample) for v in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    rows = docs.select(key, text).filter(F.col(text).isNotNull()).join(F.broadcast(chosen), key).select(F.col(text), label, key)
    found = sorted(((r[2], r[0], r[1]) for r in rows.limit(2 * sample).collect()))
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    return fit([t for _, t, _ in found], [v for _, _, v in found], prior)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "toxicity") -> DataFrame:
    """All rows and columns with the score of each whole text (0 to 1) added; null counts as empty. Narrow: no shuffle.

    A column that is called like the new one is replaced. Repeated rows get equal scores.
    """
    ready(docs.sparkSession)
    docs = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text)
            found = [model.scores(texts.slice(at, 256).to_pylist()) for at in range(0, len(texts), 256)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.empty(0), *found]))], names=[*batch.schema.names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, `{name}` double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The documents whose score is below ``threshold``, with their columns."""
    name = fresh_name(docs, "toxicity")
    return score(docs, model, text, name).filter(F.col(name) < threshold).select(*docs.columns)
