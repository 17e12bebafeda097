"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

from voxtally.llm import spelling

DDL = "doc_id bigint, text string, word string, n int"


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def _brute(counts):
    near = {w: [v for v in counts if _near(w, v)] for w in counts}
    best = {w: min(near[w], key=lambda v: (-counts[v], v), default=None) for w in counts}
    form = {w: b if b is not None and counts[b] >= 2 * counts[w] else None for w, b in best.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n, len(near[w]), counts.get(form[w], 0)) for w, n in counts.items())


def _rows(found):
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in found.collect())


def test_variants_equal_all_pairs_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PART_WORDS", 40)
    rng = random.Random(4)
    words = {"".join(rng.choices("abéÿ", k=rng.randint(1, 6))) for _ in range(500)} | {"a" * k for k in range(1, 12)} | {"b" * 3000, "b" * 2999, "b" * 1500 + "a" + "b" * 1499}
    counts = {w: rng.choice([1, 1, 2, 3, 5, 9, 20, 20, 400]) for w in words}
    table = spark.createDataFrame([*counts.items(), (None, 3)], "word string, n bigint")
    assert _rows(spelling.variants(table)) == _brute(counts)


def test_pairs_of_one_letter_group_are_counted_once(spark):
    counts = {"aab": 1, "ab": 2, "aaab": 4, "abb": 4, "cab": 2, "bab": 8}
    assert _rows(spelling.variants(spark.createDataFrame([*counts.items()], "word string, n bigint"))) == _brute(counts)


def test_shared_paths_over_ranges_name_equal_prefixes_equally():
    words = sorted({"".join(random.Random(i).choices("ab", k=6)) for i in range(60)} | {"a", "ab", "aba", "b"})
    for size in (1, 3, 7):
        parts = [words[i : i + size] for i in range(0, len(words), size)]
        owners = spelling.owned_paths([(k, p[0], p[-1]) for k, p in enumerate(parts)])
        names = {}
        for k, p in enumerate(parts):
            for w, path in zip(p, spelling._numbered(iter(p), k, p[-1], owners[k])):
                for depth, node in enumerate(path):
                    assert names.setdefault(w[:depth], node) == node
        assert len(set(names.values())) == len(names)


def test_documents_with_null_empty_long_repeated_and_clashing(spark):
    rng = random.Random(6)
    vocabulary = ["garden", "gardem", "gardens", "Straße", "strasse", "ÉTUDE", "Étude", "planet", "plánet", "planets"]
    texts = [(i, " ".join(rng.choices(vocabulary, k=60)), "x", 1) for i in range(200)]
    texts += [(7, texts[7][1], "x", 2), (None, "garden garden garden planet-planet", None, None), (900, None, "x", 1), (901, "", "x", 1), (902, "wordy," * 50_000 + "z" * 100_000, "x", 1)]
    counts = Counter()
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, text, *_ in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(upper)
            h = zlib.crc32(f"{i}:{word}".encode())
            counts[word if i is None or h % 97 else word[: h % len(word)] + word[h % len(word) + 1 :]] += 1
    want = _brute({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    docs = spark.createDataFrame(texts, DDL)
    assert _rows(spelling.spelling_variants(docs)) == want and any(r[1] for r in want)
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_registered_query_reads_the_documents(spark, tmp_path):
    from voxtally.llm.queries import LLM_QUERIES

    spark.createDataFrame([(1, "alpha alpha alpha alpha alpha alpha alphas alphas alphas")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert _rows(LLM_QUERIES["op12_spelling"](spark, str(tmp_path))) == [("alpha", "", "alpha", 6, 1, 0), ("alphas", "alpha", "alpha", 3, 1, 6)]
