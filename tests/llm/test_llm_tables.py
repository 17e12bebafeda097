"""Near copies, personal data, shards, URLs, top-k and the pipeline against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from voxtally.functions.boxes import smallest_linked
from voxtally.llm import pii, shards, simhash, topk, urls


def _print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(prints):
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    a, b = np.array(links, dtype=np.int64).reshape(-1, 2).T
    return smallest_linked(len(prints), a, b)


def _documents():
    rng = random.Random(3)
    texts = [None, "", " \n", "One", "one", "One two", "É é"]
    for _ in range(25):
        words = rng.choices(["alpha", "beta", "Gamma", "delta", "eps", "zeta"], k=rng.randint(30, 200))
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 3, 12])):
            near = list(words)
            near[rng.randrange(len(words))] = rng.choice(["new", "alpha"])
            texts.append(" ".join(near))
    return texts


@pytest.mark.parametrize("rows", [4, 1024])
def test_simhash_groups_equal_all_pairs(spark, monkeypatch, rows):
    monkeypatch.setattr(simhash, "CELL_ROWS", rows)
    texts = _documents()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, fp string").repartition(5)
    got = {r.doc_id: (int(r.h, 16), r.component_id) for r in simhash.near_duplicates(docs).withColumn("h", simhash.hex_fingerprint(F.col("fp"))).collect()}
    prints = [_print(t) for t in texts]
    assert [got[i][0] for i in range(len(texts))] == prints
    assert [got[i][1] for i in range(len(texts))] == _groups(prints).tolist()
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(_groups(prints).tolist()))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_repeated_rows_stays(spark):
    docs = spark.createDataFrame([(7, "a b c d")] * 3 + [(None, "a b c d"), (None, None), (None, None)], "doc_id bigint, text string")
    assert Counter(r.doc_id for r in simhash.drop_near_duplicates(docs).collect()) == Counter([7, None])


def test_a_crowd_of_near_fingerprints_stays_linear(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", 16)
    base = 0x0123456789ABCDEF
    crowd = sorted({base ^ (1 << i) ^ (1 << j) ^ (1 << 63) for i in range(20) for j in range(20, 40)} | {base, 5, 6})
    prints = np.array(crowd, dtype=np.uint64).view(np.int64)
    links = simhash.links(spark.createDataFrame([(int(p),) for p in prints], "fp bigint")).collect()
    place = {int(p): i for i, p in enumerate(prints)}
    root = smallest_linked(len(prints), np.array([place[r.a] for r in links]), np.array([place[r.b] for r in links]))
    assert root.tolist() == _groups(crowd).tolist()


def _luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def _base(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) < 256 for p in m[0].split("."))]
    for kind, pattern, least, most in ((2, r"[0-9]([\x20-]?[0-9])+", 14, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 10, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind == 3 or _luhn(digits)):
                found.append((m.start(), kind, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))


PIECES = ["a", "b.c", "@", "x@y.z", "+1", " ", "-", "4111 1111 1111 1111", "4111111111111111", "1.2.3.4", "300.1.1.1", ".", "5", "é", "🙂",
          "(555)", "555-0000", "+49 30 1234567", "\n", "a@b.c.d+", "bob (at) host (dot) com", "0001.002.03.4", "378282246310005", "_"]


def test_strict_spans_equal_plain_matching(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 25))) for _ in range(800)]
    texts += [None, "", "a." * 3000 + "x@" + "b." * 3000 + "c", "1" * 20_000, "+1" + " " * 9000 + "2"]
    docs = spark.createDataFrame([(i % 700, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string").repartition(4)
    found = pii.find(docs.withColumn("doc_id", F.concat_ws("#", "doc_id", F.xxhash64("text"))))
    got = Counter(r[0] for r in found.select(pii.written("spans", "s.strict")).collect())
    assert got == Counter(_base(t or "") for t in texts)
    for row in found.filter("size(spans) > 0").collect():
        assert [s.start for s in row.spans] == sorted(s.start for s in row.spans)
    assert pii.find(docs.limit(0)).count() == 0


def test_boosting_adds_disguised_spans_and_redacts(spark):
    rows = [(i, f"call me on +1 (555) 010-{i:04d} or so") for i in range(60)]
    rows += [(100 + i, f"order {i} of 12-{i}.5 pieces 4111 1111 1111 1{i:03d}") for i in range(60)]
    rows += [(900, "call me on (555) 010-0007 today"), (901, None), (902, "nothing here"), (903, "mail x@y.z from 1.2.3.4")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert out[900] == "call me on [PHONE] today" and out[0] == "call me on [PHONE] or so"
    assert out[901] is None and out[902] == "nothing here" and out[903] == "mail [EMAIL] from [IP]"


def test_no_python_in_the_native_plans(spark):
    docs = spark.createDataFrame([(1, "x@y.z")], "doc_id bigint, text string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    for frame in (pii.find(docs), pii.redact(docs), shards.shard_documents(docs), urls.judge(pages)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_matrix_has_exact_sums_and_the_right_mean():
    counts, sizes = [30, 0, 7, 63], [25, 25, 25, 25]
    drawn = np.array([shards.communication_matrix(counts, sizes, seed) for seed in range(400)])
    assert (drawn.sum(axis=2) == counts).all() and (drawn.sum(axis=1) == sizes).all()
    assert np.abs(drawn.mean(axis=0) - np.outer(counts, sizes) / 100).max() < 0.5
    variance = 30 * 0.25 * 0.75 * 70 / 99
    assert abs(drawn[:, 0, 0].var() - variance) < 0.25 * variance


def test_draws_beyond_numpy_follow_the_same_law(monkeypatch):
    rng = np.random.default_rng(1)
    near = np.array([shards.hypergeometric(40, 60, 20, rng) for _ in range(4000)])
    monkeypatch.setattr(shards, "NUMPY_LIMIT", 0)
    walked = np.array([shards.hypergeometric(40, 60, 20, rng) for _ in range(4000)])
    assert abs(near.mean() - walked.mean()) < 0.15 and abs(near.std() - walked.std()) < 0.15
    assert all(shards.hypergeometric(g, b, n, rng) == w for g, b, n, w in ((0, 9, 3, 0), (9, 0, 3, 3), (5, 5, 0, 0), (4, 4, 8, 4)))
    assert 4.9e8 < shards.hypergeometric(5 * 10**9, 5 * 10**9, 10**9, rng) < 5.1e8


def test_shards_are_exact_gapless_and_mixed(spark):
    rows = [(i // 2, None if i == 5 else "same" if i % 3 else f"é{i}", "x") for i in range(1003)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string").repartition(6)
    slim = docs.drop("shard")
    got = shards.shard_documents(slim, 8, seed=1).collect()
    sizes = Counter(r.shard for r in got)
    assert sorted(sizes.values()) == [125] * 5 + [126] * 3 and set(sizes) == set(range(8))
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    import zlib

    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    first = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert abs(np.corrcoef(first, range(len(first)))[0, 1]) < 0.15
    assert Counter(r.shard for r in shards.shard_documents(slim.limit(3), 8).collect()).total() == 3
    assert shards.shard_documents(slim.limit(0)).count() == 0


def test_urls_follow_the_rules(spark):
    hosts = ["net", "a.net", "Example.NET", "m.example.net", "example.com", "x.example.com", "org", "b.org", "notnet", "x.netz", "casino-win.example.com",
             "free-bets.example.com", "freebets.com", "ads.c.com", "adsy.com", "a.net:80", "u@b.org", "", "cheap_pills.io"]
    paths = ["", "/", "/en/", "/en", "/en/x", "/de/1", "/fr/", "?q=/en/", "#/fr/", "/a?b", "/casino/"]
    texts = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "://", "x://y://z/", "http://a.net/\n/en/"]
    pages = spark.createDataFrame([(i // 2, u, "old") for i, u in enumerate(texts)], "page_id bigint, url string, host string")

    def want(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
        fit = [r for r in rules for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        rule = max(fit, key=len, default=None)
        tokens = re.split("[^A-Za-z0-9]+", host)
        bad = {"casino", "spam", "adult", "ads", "track"} & set(tokens) or any(tokens[i : i + 2] in (["free", "bets"], ["cheap", "pills"]) for i in range(len(tokens)))
        return host, path, rule, rules[rule] if rule else "block" if bad else "allow"

    got = Counter((r.url, r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages).collect())
    assert got == Counter((u, *want(u)) for u in texts)
    assert urls.judge(pages.limit(0)).count() == 0


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 32)
    monkeypatch.setattr(topk, "SHELF_BLOCKS", 2)
    monkeypatch.setattr(topk, "CHUNK_ROWS", 3)
    rng = np.random.default_rng(0)
    values = rng.standard_normal((500, 6)).astype(np.float32).round(2)
    values[100:250] = values[7]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(values)] + [(900, None, "x"), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x"), (902, [float("nan")] * 6, "x"),
            (903, [float("inf")] * 6, "x"), (None, [1.0] * 6, "x"), (904, [], "x"), (1000, [1.0, 2.0], "x"), (3, values[3].tolist(), "x")]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank string").repartition(5)
    ready = topk.quantised(table)
    got = [tuple(r) for r in topk.top_k(ready, ready.filter("id % 100 = 0")).orderBy("query_id", "rank").collect()]
    whole = np.floor(1024 * values.astype(np.float64)).astype(np.int64)
    ids = np.append(np.arange(500), 3)
    want = []
    for q in range(0, 500, 100):
        scores = np.vstack([whole, whole[3]]) @ whole[q]
        best = sorted((-int(s), int(i)) for s, i in zip(scores, ids, strict=True) if i != q)[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == want
    assert topk.top_k(ready.limit(0), ready.limit(0)).count() == 0


def test_blocks_below_the_kth_score_are_not_scored():
    rng = np.random.default_rng(0)
    near = [(np.arange(100 * b, 100 * b + 100), rng.integers(900 - 100 * b, 1000 - 100 * b, (100, 4))) for b in range(8)]
    shelf = [(i, t, t.max(axis=0), t.min(axis=0)) for i, t in near]
    found, scored = topk.search_shelf((np.array([-1]), np.ones((1, 4), np.int64)), shelf, 10)
    assert scored <= 2 and found[0][2].max() < 200
    huge = [(np.array([1, 2]), np.array([[1 << 30], [(1 << 30) + 1]]), np.array([(1 << 30) + 1]), np.array([1 << 30]))]
    assert topk.search_shelf((np.array([0]), np.array([[1 << 30]])), huge, 1)[0][0][1][0] == (1 << 30) * ((1 << 30) + 1)


def _kept(texts):
    """First text of each group of five-word shingle sets with a Jaccard similarity of 0.8 or more, over all pairs."""
    words = [(t or "").lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    root = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return set(root)


def test_pipeline_keeps_clean_documents_and_columns(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(8)
    tongue = ["the", "ing", "on", "wh", "er", "ble"]
    prose = lambda n: " ".join("".join(rng.choices(tongue, k=3)) for _ in range(n)) + "."
    texts = {i: prose(60) for i in range(240)}
    bad = [i for i in range(240) if i % 6 == 0]
    for i in bad:
        words = texts[i].split()
        for at in (5, 20, 40):
            words[at] = "zonkvat"
        texts[i] = " ".join(words)
    texts |= {300: texts[1], 301: texts[1].replace(texts[1].split()[9], "other", 1), 302: "12 34 ?", 303: None, 304: texts[2] + " x@y.z"}
    rows = [(i, t, "en" if i % 2 else "de", "s", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in bad)) for i in range(240)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        assert name == "packing" or docs.columns == columns
        seen.append(docs)
    toxic, language, near, private, packed = ({r.doc_id for r in d.select("doc_id").collect()} for d in seen)
    assert set(texts) - toxic == set(bad)
    assert toxic - language == {302, 303}
    order = sorted(language)
    assert near == {order[r] for r in _kept([texts[i] for i in order])} and not {300, 301} & near
    assert private == near == packed
    assert {r.text for r in seen[3].filter("doc_id = 304").collect()} in ({texts[2] + " [EMAIL]"}, set())
