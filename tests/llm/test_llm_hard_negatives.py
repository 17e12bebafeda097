"""Hard negatives against brute force, the certificate of a walk, and odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtally.llm import hard_negatives as hn

DDL = "vec_id bigint, embedding array<double>, label int, row string, low int"


def _brute(rows, positives=5, negatives=5):
    held = [(i, lab, [int(np.floor(256 * x)) for x in v]) for i, v, lab, *_ in rows if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (anchor, label, terms) in enumerate(held):
        if anchor % 10:
            continue
        scores = [(-sum(x * y for x, y in zip(terms, t)), i, lab) for r, (i, lab, t) in enumerate(held) if r != a and len(t) == len(terms)]
        for s, p, _ in sorted(x for x in scores if x[2] == label)[:positives]:
            fit = sorted(x for x in scores if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s)[:negatives]
            out += [(anchor, p, k + 1, n, -s, -m) for k, (m, n, _) in enumerate(fit)]
    return sorted(out)


def _mine(spark, rows):
    found = hn.hard_negatives(hn.prepared(spark.createDataFrame(rows, DDL)), F.col("id") % 10 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def test_equals_brute_force_with_ties_nulls_copies_and_lengths(spark, monkeypatch):
    for name, value in (("SLICE_ROWS", 64), ("STEP_ROWS", 16), ("MEMBERS", 8), ("CHUNK_ROWS", 4)):
        monkeypatch.setattr(hn, name, value)
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(6, 5))
    rows = [(i, (middles[i % 6] + rng.normal(size=5) * 0.3).tolist(), int(rng.integers(0, 4)), "x", 1) for i in range(260)]
    rows += [(300 + i, [1.0, 0.5, 0.0, 0.0, 0.0], i % 2, "x", 1) for i in range(40)]  # a crowd of equal vectors, ties by id
    rows += [(10, rows[10][1], rows[10][2], "again", 1), (20, [0.0] * 5, 1, None, None)]
    rows += [(500, [1.0, 2.0], 1, "x", 1), (501, [1.0, 1.5], 1, "x", 1), (502, [0.9, 1.5], 2, "x", 1)]
    rows += [(510, None, 1, "x", 1), (520, [], 1, "x", 1), (530, [float("nan")] * 5, 1, "x", 1), (540, [1.0, None, 0.0, 0.0, 0.0], 1, "x", 1)]
    rows += [(550, [float("inf")] * 5, 1, "x", 1), (None, [1.0] * 5, 1, "x", 1), (560, [1.0] * 5, None, "x", 1)]
    want = _brute(rows)
    assert want and _mine(spark, rows) == want


def test_empty_table_and_scores_beyond_64_bits(spark):
    assert _mine(spark, []) == []
    with pytest.raises(Exception, match="too large"):
        _mine(spark, [(0, [1e7] * 4, 1, "x", 1), (1, [1e7] * 4, 1, "x", 1)])


def test_whole_numbers_beyond_doubles_stay_exact(spark):
    big = 2.0**19  # scores near 2^54
    rows = [(0, [big, 1.0], 0, "x", 1), (1, [big, 1 / 256], 0, "x", 1), (2, [big, 0.0], 1, "x", 1), (3, [big, 2 / 256], 1, "x", 1), (4, [big, 1 / 256], 1, "x", 1)]
    assert _mine(spark, rows) == _brute(rows) != []


def test_a_walk_ends_where_the_bound_certifies_it():
    rng = np.random.default_rng(5)
    centre = np.array([1.0, 0, 0, 0])
    members = np.round((centre + rng.normal(size=(6, 4)) * 0.02) * 256)
    rows = np.round(rng.normal(size=(20000, 4)) * 256)
    norm, angle = np.linalg.norm(rows, axis=1), hn._angles(rows, centre[None, :])[:, 0]
    wide = float(hn._angles(members, centre[None, :]).max())
    cluster = {"terms": members, "norm": np.linalg.norm(members, axis=1), "row": np.arange(6) - 10, "label": np.zeros(6, int), "same": True, "angle": wide}
    cluster |= {"low": np.full((6, 1), -hn.NEVER), "high": np.full((6, 1), hn.NEVER)}
    piece = {"terms": rows, "norm": norm, "angle": angle, "row": np.arange(20000), "id": np.arange(20000), "label": np.zeros(20000, int)}
    found, scored = hn.best_first(cluster, piece, 5)
    scores = (members @ rows.T).astype(int)
    for u in range(6):
        best = np.lexsort((np.arange(20000), -scores[u]))[:5]
        assert found[2][found[0] == u].tolist() == best.tolist()
    assert scored < scores.size / 4


def test_registered_query_equals_its_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from voxtally.llm.queries import LLM_ORACLE, LLM_QUERIES

    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist(), i % 3) for i in range(700)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = LLM_QUERIES["op11_hard_negatives"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(LLM_ORACLE["op11_hard_negatives"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
