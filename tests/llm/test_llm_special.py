"""Special tokens that are written out in a text, against the untouched tokenizer."""

from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from voxtally.llm import packing, queries

WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["end <|endoftext|> of <|startoftext|>x", "<|endoftext|>", "a<|endoftext|>B.<|ENDOFTEXT|> c", "<|EndOfText|>", "plain words. <|", "", "É<|startoftext|><|startoftext|>\u0301 Z  z", "<|endoftext|> word " * 900]


def test_written_special_tokens_get_their_ids():
    plain = Tokenizer.from_file(WORDS)
    want = [plain.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert want[0] == [806, 49407, 539, 49406, 343]
    got = [list(memoryview(coded).cast("I")) for coded in packing.token_bytes(TEXTS, WORDS, special=True)]
    assert got == want


def test_query_and_stage_count_them_as_one_token(spark, tmp_path):
    plain = Tokenizer.from_file(WORDS)
    want = {i: 1 + len(plain.encode(t, add_special_tokens=False).ids) for i, t in enumerate(TEXTS)}
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for frame in (queries.op5_packing(spark, str(tmp_path)), corpus_pipeline.pack_sequences(spark, docs, str(tmp_path))):
        assert {r[0]: r[1] for r in frame.groupBy("doc_id").sum("length").collect()} == want
