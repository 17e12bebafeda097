"""Stages leave columns alone whatever they are called."""

import random

from voxtally.llm import langid, pii, resemblance, toxicity

NAMES = ["t", "row", "toxicity", "odds", "lang_", "__t", "__row", "wt", "c0", "found", "chosen", "strict", "w_t", "__strict", "candidates", "spans"]


def _docs(spark):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(30)) + f" mail a{i}@host.org or +49 30 1234{i:04d}" for i in range(12)]
    rows = [(i, t, *[f"{n} {t}" for n in NAMES]) for i, t in enumerate(texts + texts[:2])]
    return spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in NAMES))


def test_no_stage_overwrites_a_column(spark):
    docs = _docs(spark)
    held = {r.doc_id: r for r in docs.collect()}
    network = langid.train(docs.selectExpr("doc_id", "text", "'en' as lang"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    stages = {
        "pii": pii.redact(docs), "copies": resemblance.drop_near_copies(docs),
        "odds": langid.drop_strange(docs, network, 1e9), "toxic": toxicity.drop_toxic(docs, model, 2.0),
    }
    for name, kept in stages.items():
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert len(rows) == (12 if name == "copies" else 14)
        for r in rows:
            assert all(r[n] == held[r.doc_id][n] for n in NAMES), name
    assert all("[EMAIL]" in r.text and "@" not in r.text and r.t.endswith(held[r.doc_id].text) for r in stages["pii"].collect())
