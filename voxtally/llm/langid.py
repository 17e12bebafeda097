"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read in windows of bytes, each from both ends; the network labels every
position, and the logarithms of these labels add up over the whole text. It is
trained in numpy by backpropagation through time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.workers import ready
from voxtally.session import fresh_name

SAMPLE = 400  # texts of each language that the network is trained on, at most
PIECES = 6  # windows taken from each of them, spread over the whole text
HIDDEN = 10
WINDOW = 64  # bytes of a window; state does not pass from one to the next
EPOCHS = 12
ROWS = 4096  # windows run together
UNKNOWN = "und"
STRANGE = 2  # windows in no language for each one of an average language
CALIBRATED, CLEAN = 2000, 0.998  # held-out texts that set the limit of the stage, and the share of them that has to stay
LEAST_LIMIT = 60.0  # evidence against all languages, as a logarithm, without which no text goes
SHORT = (8, 16, 32, 64, 128, 256)  # a text of fewer bytes has a limit of its own
SHORT_SEEN, SHORT_LIMIT = 500, 20.0  # starts of texts that such a limit takes at least, and the least evidence
SCRIPTS = ((0x61, 26), (0x3B1, 25), (0x430, 32), (0x561, 38), (0x5D0, 27), (0x627, 36), (0x905, 53), (0xE01, 46), (0x10D0, 33), (0x3041, 86), (0x4E00, 8000), (0xAC00, 11172))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


@dataclass
class Network:
    """``inputs``: byte to gate inputs (two directions, 257 bytes with padding, 3 gates of hidden units); ``loops``: recurrent weights; ``out``."""

    languages: list[str]
    inputs: np.ndarray
    loops: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        k = max(1, len(languages))
        return cls(languages, draw(2, 257, 3 * HIDDEN), draw(2, HIDDEN, 3 * HIDDEN), draw(2 * HIDDEN, k), np.zeros(k, np.float32))

    def states(self, codes: np.ndarray, side: int, keep: list | None = None) -> np.ndarray:
        """Hidden states of one direction, (steps, windows, hidden), for ``codes`` of shape (steps, windows)."""
        h = np.zeros((codes.shape[1], HIDDEN), np.float32)
        found = np.empty((*codes.shape, HIDDEN), np.float32)
        loop, table, two = self.loops[side], self.inputs[side], 2 * HIDDEN
        for t in range(len(codes)) if side == 0 else range(len(codes) - 1, -1, -1):
            given, back = table[codes[t]], h @ loop
            gates = _sigmoid(given[:, :two] + back[:, :two])
            update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
            fresh = np.tanh(given[:, two:] + reset * back[:, two:])
            before, h = h, fresh + update * (h - fresh)
            found[t] = h
            if keep is not None:
                keep.append((t, before, update, reset, fresh, back[:, two:]))
        return found

    def labels(self, codes: np.ndarray) -> np.ndarray:
        """Log-probabilities of every position, (steps, windows, languages)."""
        both = np.concatenate([self.states(codes, 0), self.states(codes, 1)], axis=2)
        logits = both @ self.out + self.bias
        logits -= logits.max(axis=2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))

    def pooled(self, codes: np.ndarray) -> np.ndarray:
        """Scores of each window, summed over its positions: (windows, languages).

        They differ from the sums of :meth:`labels` by one number a window, the
        same for all languages, so they weigh the languages alike; and the output
        layer, being linear, is applied once to the summed states.
        """
        size, k = codes.shape[1], HIDDEN
        total = (codes < 256).sum(axis=0, dtype=np.float32)[:, None] * self.bias
        padding = [np.flatnonzero(row == 256) for row in codes]
        for side in (0, 1):
            tables = [np.ascontiguousarray(self.inputs[side][:, i * k : i * k + k]) for i in range(3)]
            loops = [np.ascontiguousarray(self.loops[side][:, i * k : i * k + k]) for i in range(3)]
            h, states = np.zeros((size, k), np.float32), np.zeros((size, k), np.float32)
            gates = [np.empty((size, k), np.float32) for _ in range(2)]
            given, back = np.empty((size, k), np.float32), np.empty((size, k), np.float32)
            for t in range(len(codes)) if side == 0 else range(len(codes) - 1, -1, -1):
                for gate, table, loop in zip(gates, tables, loops, strict=False):
                    np.take(table, codes[t], axis=0, out=gate, mode="clip")
                    gate += np.matmul(h, loop, out=back)
                    gate *= 0.5
                    np.tanh(gate, out=gate)
                    gate *= 0.5
                    gate += 0.5
                update, reset = gates
                fresh = np.take(tables[2], codes[t], axis=0, out=given, mode="clip")
                np.matmul(h, loops[2], out=back)
                back *= reset
                fresh += back
                np.tanh(fresh, out=fresh)
                h -= fresh
                h *= update
                h += fresh
                states += h
                if padding[t].size:
                    states[padding[t]] -= h[padding[t]]
            total += states @ self.out[side * k : side * k + k]
        return total

    def gradient(self, codes: np.ndarray, target: np.ndarray) -> tuple[list[np.ndarray], float]:
        """Gradients of the mean cross entropy over the positions that hold a byte."""
        kept: tuple[list, list] = ([], [])
        both = np.concatenate([self.states(codes, s, kept[s]) for s in (0, 1)], axis=2)
        logits = both @ self.out + self.bias
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        held = codes < 256
        loss = -np.log(p[:, np.arange(target.size), target] + 1e-9)[held].mean()
        p[:, np.arange(target.size), target] -= 1
        p *= held[:, :, None] / np.float32(max(1, held.sum()))
        d_out = both.reshape(-1, 2 * HIDDEN).T @ p.reshape(-1, p.shape[2])
        d_both = p @ self.out.T
        d_inputs, d_loops, two = np.zeros_like(self.inputs), np.zeros_like(self.loops), 2 * HIDDEN
        for side in (0, 1):
            carry = np.zeros((target.size, HIDDEN), np.float32)
            for t, before, update, reset, fresh, inner in reversed(kept[side]):
                d = carry + d_both[t, :, side * HIDDEN : (side + 1) * HIDDEN]
                d_fresh = d * (1 - update) * (1 - fresh * fresh)
                d_update = d * (before - fresh) * update * (1 - update)
                d_reset = d_fresh * inner * reset * (1 - reset)
                d_back = np.hstack([d_update, d_reset, d_fresh * reset])
                np.add.at(d_inputs[side], codes[t], np.hstack([d_update, d_reset, d_fresh]))
                d_loops[side] += before.T @ d_back
                carry = d * update + d_back @ self.loops[side].T
        return [d_inputs, d_loops, d_out, p.sum(axis=(0, 1))], float(loss)


def cut(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts as codes (steps, windows), padded with 256, and the text each belongs to."""
    counts = [-(-len(t) // window) for t in texts]
    owner = np.repeat(np.arange(len(texts)), counts)
    padded = b"".join([t + bytes(c * window - len(t)) for t, c in zip(texts, counts, strict=True)])
    codes = np.frombuffer(padded, np.uint8).reshape(-1, window).astype(np.int16)
    last = np.cumsum(counts)
    for text, count, end in zip(texts, counts, last.tolist(), strict=True):
        if count:
            codes[end - 1, len(text) - (count - 1) * window :] = 256
    return np.ascontiguousarray(codes.T), owner


def fit(windows: list[tuple[str, str]], seed: int = 0, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.02) -> Network:
    """Train on (language, piece of text) with Adam; languages are those given."""
    languages = sorted({name for name, _ in windows})
    network = Network.fresh(languages, seed)
    if len(languages) < 2:
        return network
    place = {name: i for i, name in enumerate(languages)}
    pairs = [(place[name], piece.encode("utf-8")[:WINDOW]) for name, piece in windows if piece]
    rng = np.random.default_rng(seed)
    codes, owner = cut([b for _, b in pairs])
    target = np.array([y for y, _ in pairs])[owner]
    parts = [network.inputs, network.loops, network.out, network.bias]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step = 0
    for epoch in range(epochs):
        for at in np.array_split(rng.permutation(target.size), max(1, target.size // batch)):
            step += 1
            grads, _ = network.gradient(codes[:, at], target[at])
            norm = math.sqrt(sum(float((g * g).sum()) for g in grads))
            pace = rate * (1 - epoch / epochs) * min(1.0, 1.0 / (norm + 1e-9))
            for p, g, m, v in zip(parts, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return network


def strangers(windows: list[tuple[str, str]], seed: int = 1) -> list[tuple[str, str]]:
    """Windows in no language: the letters of given ones shuffled, invented languages in Latin letters, letters of many scripts."""
    rng = np.random.default_rng(seed)
    given = [piece for _, piece in windows if any(map(str.isalpha, piece))]
    found = []
    for i in range(STRANGE * len(given) // max(1, len({name for name, _ in windows}))):
        kind = i % 4
        if kind == 0:  # shuffled
            piece = given[int(rng.integers(len(given)))]
            letters = [c for c in piece if c.isalpha()]
            mixed = iter([letters[j] for j in rng.permutation(len(letters))])
            found.append("".join(next(mixed) if c.isalpha() else c for c in piece))
            continue
        start, many = SCRIPTS[0] if kind < 3 else SCRIPTS[int(rng.integers(len(SCRIPTS)))]
        if kind == 1:  # any letter after any
            steps = np.full((1, many), 1 / many)
        elif kind == 2:  # an invented language: each letter has a few usual successors
            steps = rng.dirichlet(np.full(many, 0.15), many)
        else:
            steps = rng.dirichlet(np.full(many, 0.5), 1)
        ends, at, out = np.cumsum(steps, axis=1), 0, []
        spaces = 0.0 if kind == 3 and rng.random() < 0.4 else 1 / rng.uniform(3, 9)
        for draw, gap in zip(rng.random(WINDOW), rng.random(WINDOW), strict=True):
            at = min(int(np.searchsorted(ends[at % len(ends)], draw)), many - 1)
            out.append(" " if gap < spaces else chr(start + at))
        piece = "".join(out)
        found.append(piece.capitalize() if rng.random() < 0.2 else piece.upper() if rng.random() < 0.05 else piece)
    return [(UNKNOWN, piece) for piece in found]


def _evidence(network: Network, texts: list[str | None]) -> tuple[np.ndarray, list[bool]]:
    """Pooled evidence for each language, and which texts have letters; the others have none."""
    lettered = [bool(t) and any(map(str.isalpha, t)) for t in texts]
    raw = [t.encode("utf-8") if ok else b"" for t, ok in zip(texts, lettered, strict=True)]
    evidence, sizes = np.zeros((len(texts), len(network.languages))), np.array([max(1, len(r)) for r in raw])
    codes, owner = cut(raw)
    if len(network.languages) > 1:
        for at in range(0, owner.size, ROWS):
            np.add.at(evidence, owner[at : at + ROWS], network.pooled(codes[:, at : at + ROWS]))
    # Neighbouring positions see the same letters: the evidence counts once for about four of them, and for no more than 100.
    evidence *= (np.minimum(sizes / 4, 100) / sizes)[:, None]
    return evidence, lettered


def predict(network: Network, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and its share of the pooled evidence for whole texts; ``und`` and 0 without letters or without a trained language."""
    if not network.languages:
        return [(UNKNOWN, 0.0)] * len(texts)
    evidence, lettered = _evidence(network, texts)
    share = np.exp(evidence - evidence.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    best = share.argmax(axis=1)
    return [(network.languages[b], float(share[i, b])) if lettered[i] else (UNKNOWN, 0.0) for i, b in enumerate(best)]


def strangeness(network: Network, texts: list[str | None]) -> np.ndarray:
    """Logarithm of the pooled odds that whole texts are in none of the languages, for a network trained with strangers; infinite without letters."""
    evidence, lettered = _evidence(network, texts)
    none = np.array([name == UNKNOWN for name in network.languages])
    known = np.logaddexp.reduce(evidence[:, ~none], axis=1)
    return np.where(lettered, np.logaddexp.reduce(evidence[:, none], axis=1) - known, np.inf)


def held_out(key: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, strange: bool = False, spare: bool = True) -> Network:
    """Fit on at most ``sample`` texts of each language that are not held out, ``PIECES`` windows of each.

    The texts are chosen by a hash of their key, the windows by a hash over the
    whole text. Rows without text or language are not used. With ``strange`` the
    network also learns ``und`` from made-up windows in no language; without
    ``spare`` it learns from held-out texts too.
    """
    usable = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.length(text) > 0) & ~(held_out(key) & spare))
    counts = {r[0]: r[1] for r in usable.groupBy(lang).count().collect()}
    chance = F.pmod(F.xxhash64(F.col(key), F.lit(3)), F.lit(1 << 20)) / float(1 << 20)
    found: list[tuple[str, str]] = []
    for name, n in sorted(counts.items()):
        some = usable.filter((F.col(lang) == name) & (chance < 1.1 * sample / n)).select(key, text).limit(sample)
        starts = F.transform(F.sequence(F.lit(1), F.lit(PIECES)), lambda i: 1 + F.pmod(F.xxhash64(F.col(key), i), F.greatest(F.lit(1), F.length(text) - WINDOW + 1)).cast("int"))
        pieces = some.select(key, F.explode(F.array_distinct(starts)).alias("start"), text).select(key, "start", F.substring(F.col(text), F.col("start"), F.lit(WINDOW)).alias("piece"))
        found += [(name, r["piece"]) for r in sorted(pieces.collect(), key=lambda r: (r[0] is None, r))]
    return fit(found + strangers(found) if strange else found)


def train_anyhow(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network:
    """A network that knows strangers, from what there is: labelled texts outside the held-out fifth, else all labelled ones, else all with letters as one language.

    It has no language but ``und`` only where no text has a letter.
    """
    lettered = docs.filter(F.col(text).rlike(r"\p{L}")).select(key, text, F.col(lang).cast("string").alias(lang))
    same = lettered.withColumn(lang, F.lit("any"))
    for rows, spare in ((docs, True), (lettered, False), (same, False)):
        network = train(rows, key, text, lang, strange=True, spare=spare)
        if set(network.languages) - {UNKNOWN}:
            break
    return network


def label(docs: DataFrame, network: Network, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """All rows and columns with the predicted language and its score (0 to 1) added. Narrow: no shuffle.

    A text that is null, empty or without letters is ``und`` with score 0.
    Columns called like the new ones are replaced; repeated rows get equal labels.
    """
    ready(docs.sparkSession)
    docs = docs.drop(lang, score)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(text), []
            for at in range(0, len(texts), 128):
                found += predict(network, texts.slice(at, 128).to_pylist())
            columns = [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, lang, score])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, `{lang}` string, `{score}` double")


def drop_unknown(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """The documents that are in some language, i.e. not ``und``, with their columns."""
    lang, score = fresh_name(docs, "lang"), fresh_name(docs, "score")
    return label(docs, network, text, lang, score).filter(F.col(lang) != UNKNOWN).select(*docs.columns)


def _judged(docs: DataFrame, network: Network, text: str, name: str) -> DataFrame:
    """All rows and columns with the strangeness of each whole text added."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text)
            found = [strangeness(network, texts.slice(at, 128).to_pylist()) for at in range(0, len(texts), 128)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.empty(0), *found]))], names=[*batch.schema.names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, `{name}` double")


def _some_held_out(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """``key`` and ``text`` of about ``CALIBRATED`` held-out lettered texts with a language."""
    usable = docs.filter(held_out(key) & F.col(key).isNotNull() & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(key, text)
    chance = F.pmod(F.xxhash64(F.col(key), F.lit(5)), F.lit(1 << 20)) / float(1 << 20)
    return usable.filter(chance < CALIBRATED / max(1, usable.count()))


def calibrate(docs: DataFrame, network: Network, key: str = "doc_id", text: str = "text", lang: str = "lang") -> float:
    """The strangeness that ``CLEAN`` of about ``CALIBRATED`` held-out lettered texts with a language stay below, at least ``LEAST_LIMIT``."""
    some = _some_held_out(docs, key, text, lang)
    found = sorted(r[0] for r in _judged(some, network, text, "__odds").select("__odds").collect())
    return max(LEAST_LIMIT, 1.0 + found[math.ceil(CLEAN * len(found)) - 1]) if found else LEAST_LIMIT


def calibrate_short(docs: DataFrame, network: Network, limit: float, key: str = "doc_id", text: str = "text", lang: str = "lang") -> list[tuple[int, float]]:
    """By size below which it holds, the strangeness that the starts of the held-out texts stay below, at least ``SHORT_LIMIT``; ``limit`` at most, and where few have the size."""
    starts = F.array_distinct(F.transform(F.array(*map(F.lit, SHORT)), lambda n: F.substring(F.col(text), F.lit(1), n - 1)))
    pieces = _some_held_out(docs, key, text, lang).select(F.explode(starts).alias(text)).filter(F.col(text).rlike(r"\p{L}"))
    size = F.octet_length(text)
    found = _judged(pieces, network, text, "__odds").groupBy(_by_size(size, [(n, n) for n in SHORT], None).alias("below")).agg(F.count("*"), F.max("__odds")).collect()
    seen = {r[0]: max(SHORT_LIMIT, 1.0 + r[2]) for r in found if r[1] >= SHORT_SEEN}
    return [(n, min(limit, seen.get(n, limit))) for n in SHORT]


def _by_size(size: F.Column, values: list[tuple[int, float]], rest: float | None) -> F.Column:
    found = F.lit(rest)
    for below, value in reversed(values):
        found = F.when(size < below, value).otherwise(found)
    return found


def drop_strange(docs: DataFrame, network: Network, limit: float, text: str = "text", short: list[tuple[int, float]] | None = None) -> DataFrame:
    """The documents with letters whose strangeness is at most ``limit``, or that of their size in ``short``, with their columns."""
    name = fresh_name(docs, "odds")
    most = _by_size(F.octet_length(text), short or [], limit)
    return _judged(docs, network, text, name).filter(F.col(name) <= most).select(*docs.columns)


def drop_letterless(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with a letter, with their columns."""
    return docs.filter(F.coalesce(F.col(text), F.lit("")).rlike(r"\p{L}"))
