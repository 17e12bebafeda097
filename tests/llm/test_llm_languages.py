"""The language stage of the pipeline: what it keeps without training, and what the network rejects."""

import random

import corpus_pipeline
from voxtally.llm import langid


def test_lettered_documents_stay_where_nothing_could_be_trained(spark):
    texts = ["clean words", "ü", "日本", "123 ?!", "", None, " \n"]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    assert langid.train(docs).languages == []
    kept = corpus_pipeline.keep_languages(spark, docs, "")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {0, 1, 2}
    held = docs.filter(langid.held_out() & (langid.F.col("doc_id") < 3)).withColumn("lang", langid.F.lit("en"))
    assert corpus_pipeline.keep_languages(spark, held, "").count() == held.count()


def test_lettered_texts_in_no_learned_language_go(spark):
    rng = random.Random(3)
    tongues = {"aa": ["the", "ing", "on", "wh", "er"], "bb": ["sch", "ü", "ver", "keit", "ein"]}
    prose = lambda parts, n: " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n)) + "."
    clean = [(i, prose(tongues[lang], rng.randint(1, 60)), lang) for i in range(300) for lang in [sorted(tongues)[i % 2]]]
    italian = "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita. "
    strange = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz   ", k=300)), "Все люди рождаются свободными и равными в своем достоинстве и правах. " * 3, italian * 3, "人人生而自由在尊严和权利上一律平等" * 5, prose(["kna", "puli", "zom", "vaq"], 60)]
    rows = clean + [(400 + i, t, None) for i, t in enumerate(strange)] + [(500, "12 ?", "aa"), (501, None, "bb")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = corpus_pipeline.keep_languages(spark, docs, "")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _, _ in clean}


def _corpus(lang, n=250):
    rng = random.Random(5)
    prose = lambda: " ".join("".join(rng.choices(["the", "ing", "on", "wh", "er", "st"], k=rng.randint(1, 3))) for _ in range(60)) + "."
    strange = ["Все люди рождаются свободными и равными в своем достоинстве и правах. " * 4, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz   ", k=400))]
    return [(i, prose(), lang(i)) for i in range(n)] + [(9000 + i, t, None) for i, t in enumerate(strange)] + [(9500, "12 ?", None), (9501, None, None)]


def test_the_network_judges_where_labels_are_held_out_or_missing(spark):
    ids = spark.range(250).withColumnRenamed("id", "doc_id")
    held = {r.doc_id for r in ids.filter(langid.held_out()).collect()}
    for lang, learned in ((lambda i: "aa" if i in held else None, set()), (lambda i: None, {9000})):  # what it is trained on may stay
        docs = spark.createDataFrame(_corpus(lang), "doc_id bigint, text string, lang string")
        assert langid.train(docs).languages == []
        kept = corpus_pipeline.keep_languages(spark, docs, "")
        assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} - learned == set(range(250))


def test_short_texts_are_judged_by_limits_of_their_size(spark, monkeypatch):
    monkeypatch.setattr(langid, "SHORT_SEEN", 20)
    docs = spark.createDataFrame(_corpus(lambda i: "aa"), "doc_id bigint, text string, lang string")
    few = [(9600, "Все люди", None), (9601, "人人生而自由", None), (9602, "the sting on", None), (9603, "On.", None)]
    docs = docs.unionByName(spark.createDataFrame(few, docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.keep_languages(spark, docs, "").collect()}
    assert kept == {*range(250), 9602, 9603}
