"""Benchmark passages against brute force, proximity matches and odd tables."""

import hashlib
import random
import re

import pytest

from voxtally.llm import contamination as con

DOCS, ITEMS = "doc_id bigint, text string, row string, n_hit int", "item_id bigint, text string, phrase int"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text):
    return WORD.findall((text or "").translate(UPPER))


def _brute(docs, items, window=10):
    phrases = {}
    for key, text, *_ in items:
        w = _words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[i : i + window]), set()).add(key)
    sizes = sorted({len(p) for p in phrases})
    out = []
    for key, text, *_ in docs:
        w, hit, found = _words(text), set(), set()
        for i in range(len(w)):
            for size in sizes:
                named = phrases.get(tuple(w[i : i + size])) if i + size <= len(w) else None
                if named:
                    hit |= set(range(i, i + size))
                    found |= named
        names = sorted(str(f) for f in found if f is not None)
        out.append((key, len(w), len(hit), len(names), ",".join(names), bool(hit)))
    return sorted(out, key=str)


def _got(found):
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "item_ids", "contaminated"]
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.fixture
def tables():
    rng = random.Random(11)
    words = ["the", "of", "Été", "42", "漢字", "x", *("w%d" % i for i in range(30))]
    some = lambda n: " ".join(rng.choices(words, [30, 20, 5, 5, 2, 2, *[1] * 30], k=n))
    items = [(i, some(rng.choice([3, 9, 10, 11, 25])), i) for i in range(40)]
    items += [(40, items[0][1], 0), (5, some(15), 0), (41, None, 0), (42, " .. ", 0), (None, some(12), 0), (43, "the of the of the of the of the of the", 0)]
    docs = [(i, some(rng.randint(1, 80)), "x", 1) for i in range(120)]
    docs += [(200 + i, some(20) + "! " + items[i % 46][1].upper() + "-" + some(5), "x", 1) for i in range(46) if items[i % 46][1]]
    docs += [(300, None, None, None), (301, "", "x", 1), (302, "the of " * 4000 + items[4][1], "x", 1), (None, items[3][1], "x", 1), (3, docs[3][1], "x", 2)]
    docs += [(303, items[7][1].split()[0], "x", 1), (304, some(5) + items[8][1], "x", 1)]
    return docs, items


def test_hits_equal_brute_force_over_segments_and_blocks(spark, tables, monkeypatch):
    docs, items = tables
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    want = _brute(docs, items)
    assert sum(r[5] for r in want) > 40
    assert _got(con.contamination(*frames)) == want
    monkeypatch.setattr(con, "SEGMENT_WORDS", 200)
    monkeypatch.setattr(con, "SEED_ROWS", 7)
    monkeypatch.setattr(con.matches, "__defaults__", (None, 30))
    assert _got(con.contamination(*frames)) == want


def test_empty_tables(spark, tables):
    docs, items = spark.createDataFrame(tables[0], DOCS), spark.createDataFrame(tables[1], ITEMS)
    assert con.contamination(docs.limit(0), items).count() == 0
    assert _got(con.contamination(docs, items.limit(0))) == _brute(tables[0], [])


def test_words_near_each_other_in_any_order(spark):
    docs = [(1, "red " + "x " * 6 + "green blue"), (2, "blue red y y green"), (3, "red green"), (4, "red " + "x " * 40 + "green blue"), (5, "green"), (6, "blue red y y green " * 2)]
    items = spark.createDataFrame([(9, "red green blue")], "item_id bigint, text string")
    found = con.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), items, distance=8)
    assert {r.doc_id for r in found.filter("contaminated").collect()} == {1, 2, 6}
    with pytest.raises(ValueError, match="distance"):
        con.matches(None, None, con.GAP)


def test_registered_query_equals_its_sql(spark, tables, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from voxtally.llm.queries import LLM_ORACLE, LLM_QUERIES

    spark.createDataFrame(tables[0], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(tables[1], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(map(tuple, LLM_QUERIES["op13_contamination"](spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(((*r[:4], hashlib.sha256(r[4].encode()).hexdigest(), r[5]) for r in _brute(*tables)), key=str)
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    assert sorted(db.execute(LLM_ORACLE["op13_contamination"]).fetchall(), key=str) == got
