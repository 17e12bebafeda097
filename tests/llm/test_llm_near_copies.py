"""Near copies come from op1's SimHash grid, and a crowd of them leaves a task as spanning links."""

import random

import numpy as np
import pyarrow as pa
import pytest

from voxtally.functions.boxes import smallest_linked
from voxtally.llm import resemblance, simhash


def _crowd(n, seed=3):
    """Texts of one family; some of the pairs reach the similarity."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    base, texts = [word() for _ in range(150)], []
    for _ in range(n):
        near = list(base)
        for _ in range(rng.randint(1, 5)):
            near[rng.randrange(150)] = word()
        texts.append(" ".join(near))
    return texts


def _all_pairs(sets):
    return [(i, j) for i in range(len(sets)) for j in range(i) if resemblance.similar(sets[i], sets[j])]


def _roots(n, links):
    a, b = np.array(list(links), np.int64).reshape(-1, 2).T
    return smallest_linked(n, a, b).tolist()


@pytest.mark.parametrize("blocks", [1, 3])
def test_a_crowd_of_near_copies_gives_no_more_links_than_rows(blocks):
    texts = _crowd(240)
    sets = [resemblance.shingles(t) for t in texts]
    alike = _all_pairs(sets)
    assert len(alike) > 10 * len(texts)
    rows = [(7, min(i % blocks, o), max(i % blocks, o), i % blocks, i, t) for i, t in enumerate(texts) for o in range(blocks)]
    columns = [list(c) for c in zip(*sorted(rows), strict=True)]
    batches = pa.table(columns, names=["root", "x", "y", "block", "node", "text"]).to_batches(max_chunksize=50)
    links = [(r["a"], r["b"]) for batch in resemblance._met_in_task(iter(batches)) for r in batch.to_pylist()]
    assert len(links) <= blocks * len(texts)
    assert _roots(len(texts), links) == _roots(len(texts), alike)


@pytest.mark.parametrize("crowd", [4, 64])
def test_wide_links_equal_all_pairs_that_meet(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "WIDE_ROWS", 300)
    texts = _crowd(60) + _crowd(30, 4) + [f"one text of its own {i} " * 9 for i in range(20)]
    prints = np.stack([simhash.wide_fingerprint(resemblance.shingles(t)) for t in texts])
    cells = simhash.wide_cells(prints)
    words = ", ".join(f"w{k} bigint" for k in range(simhash.WORDS))
    rows = [(i, c.tolist(), *w.view(np.int64).tolist()) for i, (c, w) in enumerate(zip(cells, prints, strict=True))]
    nodes = spark.createDataFrame(rows, f"node bigint, cells array<int>, {words}")
    parts = prints.view(np.uint16).reshape(len(texts), simhash.PARTS)
    meet = [
        (i, j) for i in range(len(texts)) for j in range(i)
        if np.bitwise_count(prints[i] ^ prints[j]).sum() <= simhash.WIDE_RADIUS and np.bitwise_count(parts[i] ^ parts[j]).min() <= 1
    ]
    links = [(r.a, r.b) for r in simhash.wide_links(nodes).collect()]
    assert _roots(len(texts), links) == _roots(len(texts), meet)
    assert set(_all_pairs([resemblance.shingles(t) for t in texts])) <= set(meet)


def test_the_near_duplicate_stage_takes_its_pairs_from_simhash(spark, monkeypatch):
    import corpus_pipeline

    docs = spark.createDataFrame(list(enumerate(_crowd(12))), "doc_id bigint, text string")
    assert corpus_pipeline.drop_near_duplicates(spark, docs, "").count() < 12
    monkeypatch.setattr(simhash, "wide_links", lambda nodes: nodes.selectExpr("node as a", "node as b").limit(0))
    assert corpus_pipeline.drop_near_duplicates(spark, docs, "").count() == 12
