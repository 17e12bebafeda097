"""The registered queries of this subpackage and, where SQL can say the same, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from voxtally.llm import bpe, contamination, hard_negatives, langid, packing, pii, quality, shards, simhash, spelling, topk, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    counts = [F.expr(f"size(filter(spans, s -> s.kind = {i}))").cast("bigint").alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    base = F.sha2(pii.written("spans", "s.strict").cast("binary"), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), pii.written("spans").alias("spans"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard_documents(_table(spark, sf_dir, "documents"))
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), special=True)


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = langid.train(docs)
    return langid.label(docs.drop("lang"), network).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return toxicity.score(docs, model, name="score").select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted)


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.quantised(_table(spark, sf_dir, "embeddings"))
    return topk.top_k(rows, rows.filter(F.col("id") % 100 == 0))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.apply_policy(quality.ledger(_table(spark, sf_dir, "documents")), quality.STANDARD)
    measured = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select(*measured, quality.failed(quality.BASE.mask()).alias("base_failed"), "kept")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(hard_negatives.prepared(vectors.withColumn("label", label)), F.col("id") % 100 == 0)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op13_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.col("item_ids").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


LLM_QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_pii": op2_pii,
    "op3_shards": op3_shards,
    "op4_bpe": op4_bpe,
    "op5_packing": op5_packing,
    "op6_langid": op6_langid,
    "op7_urls": op7_urls,
    "op8_toxicity": op8_toxicity,
    "op9_topk": op9_topk,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling": op12_spelling,
    "op13_contamination": op13_contamination,
}

_URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_FIRED = " or ".join(f"regexp_matches(host || path, '{r.pattern}')" for r in urls.WORD_RULES)

LLM_ORACLE: dict[str, str] = {
    "op7_urls": f"""
with parts as (
    select page_id,
        translate(regexp_extract(coalesce(url, ''), '{_URL_PARTS}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '{_URL_PARTS}', 2) as path
    from pages
), judged as (
    select *, case
        when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
        when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
        when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
        when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/'
    end as rule
    from parts
)
select page_id, host, path, rule, case
    when rule in ('net/', 'example.com/de/') then 'block'
    when rule is not null then 'allow'
    when {_FIRED} then 'block'
    else 'allow'
end as verdict
from judged
""",
    "op9_topk": """
with vectors as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as terms
    from embeddings
    where vec_id is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, r.vec_id, list_inner_product(q.terms, r.terms)::bigint as score
    from vectors q join vectors r on r.vec_id <> q.vec_id
    where q.vec_id % 100 = 0
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 10
""",
    "op10_quality": r"""
with texts as (
    select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents
), words as (
    select rid, doc_id, text, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') as w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) as lines
    from texts
), places as (
    select rid, unnest(w) as word, generate_subscripts(w, 1) as pos from words
), windows as (
    select rid, pos, word || ' ' || lead(word, 1) over p || ' ' || lead(word, 2) over p || ' ' || lead(word, 3) over p || ' ' || lead(word, 4) over p as five
    from places window p as (partition by rid order by pos)
), counted as (
    select rid, pos, case when five is null then 0 else count(*) over (partition by rid, five) end as n from windows
), covered as (
    select rid, max(n) over (partition by rid order by pos rows between 4 preceding and current row) > 1 as again from counted
), repeats as (
    select rid, count(*) filter (again) as n_repeat_words from covered group by rid
), measured as (
    select doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words
    from words left join repeats using (rid)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    not (n_words < 10 or 100 * n_repeat_words > 20 * n_words or (n_lines >= 4 and 2 * n_dup_lines > n_lines)
        or n_symbols > n_words or word_chars > 40 * n_words) as kept
from measured
""",
    "op11_hard_negatives": """
with rows as (
    select row_number() over () as rid, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as terms
    from embeddings
    where vec_id is not null and label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.rid as anchor, a.vec_id as anchor_id, r.rid, r.vec_id, a.label = r.label as same, list_inner_product(a.terms, r.terms)::bigint as score
    from rows a join rows r on a.rid <> r.rid
    where a.vec_id % 100 = 0
), positives as (
    select *, row_number() over (partition by anchor order by score desc, vec_id, rid) as place from scored where same qualify place <= 5
), met as (
    select p.anchor_id, p.vec_id as positive_id, p.score as positive_score, n.vec_id as negative_id, n.score as negative_score,
        row_number() over (partition by p.anchor, p.place order by n.score desc, n.vec_id, n.rid)::int as rank
    from positives p join scored n on p.anchor = n.anchor and not n.same and 80 * p.score <= 100 * n.score and n.score <= p.score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from met where rank <= 5
""",
    "op13_contamination": r"""
with texts as (
    select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), items as (
    select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
), placed as (
    select item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from items where len(w) > 0
), windows as (
    select distinct item_id, least(10, len(w)) as size, array_to_string(w[i:i + 9], ' ') as words from placed
), spots as (
    select rid, w, unnest(range(1, len(w) + 1)) as i from texts
), spans as (
    select rid, i, size, array_to_string(w[i:i + size - 1], ' ') as words
    from spots join (select distinct size from windows) on i + size - 1 <= len(w)
), found as (
    select rid, i, s.size, item_id from spans s join windows v on s.words = v.words and s.size = v.size
), hit as (
    select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + size)) as p from found) group by rid
), named as (
    select rid, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from found group by rid
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from texts left join hit using (rid) left join named using (rid)
""",
}
