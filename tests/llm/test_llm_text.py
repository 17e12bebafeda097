"""Tokenising, packing, language, toxicity and quality against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from voxtally.llm import bpe, langid, packing, quality, toxicity

tiktoken = pytest.importorskip("tiktoken")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n\t\r\v\f", "a", "word " * 3000, "x" * 20_000, " " * 5000, "é" * 999, "日本語🙂 ́x", "\x00\x1c\x85", "1 2 3", "<|endoftext|>", "same text", "same text", "Σας ΣΑΣ"]


def frame(spark, texts, **more):
    """A table of texts with a null and a repeated key and an extra column that clashes with results."""
    keys = [None, *range(len(texts) - 1)]
    keys[2] = keys[1]
    rows = [(k, t, "x", -1.5) for k, t in zip(keys, texts, strict=True)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, score double").repartition(3)


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def known():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abethin g  \n'ésß日🙂12!#\x00 ́　")), max_size=60))
def test_encoding_is_that_of_merging_by_rank(codec, known, text):
    ids = codec.encode(text)
    assert ids == known.encode_ordinary(text)
    assert "".join(codec.decode(ids)) == text


def test_the_transducer_does_not_depend_on_its_memory(known, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 5)
    monkeypatch.setattr(bpe, "MAX_WORDS", 2)
    own = bpe.Codec(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    text = "unbelievable internationalization of tokenizers " * 3
    assert own.encode(text) == known.encode_ordinary(text)


def test_bytes_cut_anywhere_decode_alike():
    data = "aé日🙂z".encode() + b"\xff\xe6\x97" + "é".encode() + b"\xf0\x9f"
    for width in range(1, 6):
        stream = bpe.Utf8Stream()
        out = "".join(stream.feed(data[i : i + width]) for i in range(0, len(data), width)) + stream.close()
        assert out == data.decode("utf-8", "replace")


def test_bpe_round_trip_over_odd_texts(spark, known):
    docs = frame(spark, ODD)
    got = Counter(tuple(r) for r in bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect())
    want = Counter()
    for r in docs.collect():
        ids = known.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert got == want
    back = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert Counter(r.text for r in back.collect()) == Counter(t or "" for t in ODD)
    assert bpe.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_best_fit_equals_placing_one_by_one():
    rng = random.Random(1)
    for _ in range(150):
        limit = rng.choice([5, 16, 50, 2048])
        lengths = [rng.randint(1, limit) for _ in range(rng.randint(0, 100))]
        left = []
        for n in sorted(lengths, reverse=True):
            fitting = [b for b, free in enumerate(left) if free >= n]
            if fitting:
                left[min(fitting, key=left.__getitem__)] -= n
            else:
                left.append(limit - n)
        used, cells = Counter(), set()
        for length, _, documents, first, each, offset in packing.best_fit(Counter(lengths), limit).tolist():
            for i in range(documents):
                used[first + i // each] += length
                cells |= {(first + i // each, offset + i % each * length + j) for j in range(length)}
        assert len(cells) == sum(lengths)
        assert sorted(limit - u for u in used.values()) == sorted(left)


@pytest.mark.parametrize("limit", [16, 2048])
def test_packing_keeps_every_token_once(spark, limit):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    docs = frame(spark, ODD)
    rows = packing.pack_documents(docs.drop("ids"), WORDS, limit, ids=True).collect()
    texts = Counter()
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        for i, at in enumerate(range(0, len(ids), limit)):
            texts[r.doc_id, i, at, tuple(ids[at : at + limit])] += 1
    assert Counter((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in rows) == texts
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        ends = [0]
        for offset, length in sorted(spans):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= limit
    plan = packing.best_fit(Counter(r.length for r in rows), limit)
    assert len(sequences) == sum(-(-n // each) for _, _, n, _, each, offset in plan.tolist() if offset == 0)
    assert packing.pack_documents(docs.limit(0).drop("ids"), WORDS).count() == 0


def _measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines), len(lines) - len(set(lines)), len(again)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab  \n#é\x1c ")), max_size=120))
def test_measures_equal_their_definition(text):
    assert quality.measures(text) == _measured(text)


def test_ledger_policies_and_ablations(spark):
    lines = "one two three four five six seven eight nine ten eleven\n"
    texts = [*ODD, lines, lines * 4, "# $ % & | < > * # $ % & a b c d", "w" * 500 + " b" * 10]
    rows = quality.ledger(frame(spark, texts))
    got = Counter((r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) for r in rows.collect())
    assert got == Counter(map(_measured, texts))
    found = {(r.policy, r.rule): (r.fail, r.fail_alone, r.kept_without) for r in quality.ablations(rows, (quality.BASE, quality.STANDARD)).collect()}
    for policy in (quality.BASE, quality.STANDARD):
        kept = quality.apply_policy(rows, policy).collect()
        for i, (name, _) in enumerate(quality.RULES):
            if name in policy.rules:
                others = policy.mask() & ~(1 << i)
                failing = [r for r in kept if r.failures >> i & 1]
                want = len(failing), sum(not r.failures & others for r in failing), sum(not r.failures & others for r in kept)
                assert found[policy.version, name] == want
        assert sum(r.kept for r in kept) == sum(not r.failures & policy.mask() for r in kept)
    assert quality.ledger(frame(spark, ODD).limit(0)).count() == 0


def _prose(rng, syllables, n):
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n)) + "."


TONGUES = {"aa": ["the", "ing", "on", "wh"], "bb": ["sch", "ü", "ver", "keit"], "cc": ["eau", "ré", "que", "ç"]}


def test_language_on_held_out_texts(spark):
    rng = random.Random(2)
    rows = [(i, _prose(rng, TONGUES[lang], rng.randint(8, 60)), lang) for i in range(300) for lang in [sorted(TONGUES)[i % 3]]]
    rows += [(500, None, "aa"), (501, "", "bb"), (502, "123 ?!", "cc"), (503, "keitü schver", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = langid.label(docs, langid.train(docs, sample=60)).withColumn("out", langid.held_out()).collect()
    judged = [r for r in got if r.doc_id < 500 and r.out]
    assert len(judged) > 30 and sum(r.lang == r.lang_pred for r in judged) >= 0.9 * len(judged)
    assert {r.doc_id: (r.lang_pred, r.score) for r in got if 500 <= r.doc_id < 503} == dict.fromkeys((500, 501, 502), ("und", 0.0))
    assert all(0 <= r.score <= 1 for r in got) and {r.doc_id for r in langid.drop_unknown(docs, langid.fit([])).collect()} == set()
    assert langid.label(docs.limit(0), langid.fit([("aa", "the"), ("bb", "ü")], epochs=1)).count() == 0


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    network = langid.Network.fresh(["a", "b", "c"], 1)
    for name in ("inputs", "loops", "out", "bias"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    codes = rng.integers(97, 100, (7, 4)).astype(np.int16)
    codes[5:, 1] = 256
    target = np.array([0, 1, 2, 1])
    grads, _ = network.gradient(codes, target)
    for part, grad in zip((network.inputs, network.loops, network.out, network.bias), grads, strict=True):
        for at in rng.permutation(np.flatnonzero(grad))[:4]:
            at, step = np.unravel_index(at, part.shape), 1e-2
            part[at] += step
            up = network.gradient(codes, target)[1]
            part[at] -= 2 * step
            down = network.gradient(codes, target)[1]
            part[at] += step
            assert abs((up - down) / (2 * step) - grad[at]) < 2e-3


def test_pooled_scores_weigh_languages_like_the_labels():
    network = langid.Network.fresh(["a", "b", "c"], 1)
    codes, owner = langid.cut([b"the first text, " * 9, b"x", b"", "zwölf".encode()])
    labels = (network.labels(codes) * (codes < 256)[:, :, None]).sum(axis=0)
    pooled = network.pooled(codes)
    assert owner.tolist() == [0, 0, 0, 1, 3]
    np.testing.assert_allclose(pooled - pooled[:, :1], labels - labels[:, :1], atol=1e-3)


def _toxic_rows(n):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        words = _prose(rng, TONGUES["aa"], 60).split()
        toxic = i % 4 == 0
        for _ in range(3 * toxic):
            words[rng.randrange(60)] = rng.choice(["grubbel", "grubbler", "zonkvat", "zonkvats"])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_on_held_out_and_disguised_texts(spark):
    rows = _toxic_rows(600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, None), (1001, "")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, v) for i, _, v in rows] + [(None, 1), (3000, None)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).withColumn("out", toxicity.held_out()).collect()
    truth = {i: v for i, _, v in rows}
    judged = [(truth[r.doc_id], r.toxicity >= 0.7) for r in got if r.doc_id < 1000 and r.out]
    assert sum(a == b for a, b in judged) >= 0.97 * len(judged) and sum(a for a, _ in judged) > 30
    assert all(r.toxicity < 0.5 for r in got if r.doc_id >= 1000)
    clean, base = next(t for _, t, v in rows if not v), "theing onwh "
    disguised = clean + " gru-bbel zon.kvat and g r u b b e l grubxbel. Zonk_vats!"
    low, high = model.scores([clean + base * 4, disguised])
    assert low < 0.3 < 0.7 < high
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_without_labels_or_with_one_class(spark):
    assert toxicity.fit([], []).scores(["anything", None]).max() < 0.01
    assert toxicity.fit(["a", "b"], [1, 1]).scores(["x"]).min() > 0.99
