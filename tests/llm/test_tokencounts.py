"""Token counts against the tokenizer itself, and what the cache saves."""

from __future__ import annotations

import uuid

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from obsvar.llm import tokencounts
from obsvar.session import scratch_path

from .helpers import EDGES, edge_docs, empty_docs, prose

BPE = public_tokenizers.path("byte_bpe_50k.json")


def n_tokens(text):
    return len(Tokenizer.from_file(BPE).encode(text or "", add_special_tokens=False))


def test_edges_equal_the_tokenizer(spark):
    docs = edge_docs(spark, "_digest").withColumn("n_tokens", F.lit("mine"))
    got = tokencounts.counted(docs, BPE, scratch_path(spark, "test-cache"))
    assert got.columns == [*docs.columns, "tokens"]
    seen = sorted((repr(r.doc_id), r.text or "", r.tokens.n_bytes, r.tokens.n_tokens, r.n_tokens) for r in got.collect())
    assert seen == sorted((repr(r[0]), r[1] or "", len((r[1] or "").encode()), n_tokens(r[1]), "mine") for r in EDGES)


def test_special_strings_in_texts_follow_the_default(spark):
    text = "an <|endoftext|> inside, <|endoftext|>"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert tokencounts.counted(docs, BPE, scratch_path(spark, "test-cache")).first().tokens.n_tokens == n_tokens(text)


def test_only_misses_are_encoded_and_appended(spark):
    cache = scratch_path(spark, "test-cache")
    docs = spark.createDataFrame([(k, prose(30, k % 40)) for k in range(200)], "doc_id long, text string").repartition(6)
    more = docs.union(spark.createDataFrame([(1_000 + k, prose(30, k + 30)) for k in range(30)], docs.schema))

    def stored():
        return spark.read.parquet(cache).groupBy("digest").count()

    first = {r.doc_id: r.tokens.n_tokens for r in tokencounts.counted(docs, BPE, cache).collect()}
    assert stored().count() == 40 and stored().filter("count > 1").isEmpty()
    second = {r.doc_id: r.tokens.n_tokens for r in tokencounts.counted(more, BPE, cache).collect()}
    assert stored().count() == 60 and stored().filter("count > 1").isEmpty()
    assert all(second[k] == n for k, n in first.items())
    assert all(second[1_000 + k] == n_tokens(prose(30, k + 30)) for k in range(30))


def test_counts_in_the_cache_are_what_is_returned(spark):
    """A planted count comes back, so stored texts are not encoded again; another tokenizer has its own."""
    cache, docs = scratch_path(spark, "test-cache"), spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    version = tokencounts.tokenizer_digest(BPE)
    planted = docs.select(tokencounts.content_digest().alias("digest"), F.lit(77).cast("bigint").alias("n_tokens"))
    planted.withColumn("tokenizer", F.lit(version)).write.partitionBy("tokenizer").parquet(cache)
    assert tokencounts.counted(docs, BPE, cache).first().tokens.n_tokens == 77
    other = public_tokenizers.path("piece_bpe_32k.model")
    import sentencepiece

    want = len(sentencepiece.SentencePieceProcessor(model_file=other).encode("some text"))
    assert tokencounts.counted(docs, other, cache).first().tokens.n_tokens == want
    assert tokencounts.counted(docs, BPE, cache).first().tokens.n_tokens == 77


def test_empty_table_and_unknown_tokenizer(spark):
    assert tokencounts.counted(empty_docs(spark), BPE, scratch_path(spark, "test-cache")).collect() == []
    with pytest.raises(ValueError, match="neither"):
        tokencounts.counted(empty_docs(spark), f"/tmp/{uuid.uuid4().hex}.txt", "/tmp/none")


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'sdll 1\n\té \x1c.,<|endoftext>")), max_size=300), st.integers(1, 30))
def test_parts_add_up(text, size):
    tokenizer = Tokenizer.from_file(BPE) if not hasattr(test_parts_add_up, "t") else test_parts_add_up.t
    test_parts_add_up.t = tokenizer
    pieces = list(tokencounts.parts(text, size))
    assert "".join(pieces) == text
    assert sum(len(tokenizer.encode(p, add_special_tokens=False)) for p in pieces) == len(tokenizer.encode(text, add_special_tokens=False))


def test_a_very_long_text_is_counted_in_parts(spark):
    text = " ".join(prose(400, k, 10_000) for k in range(200)) + "\n\n  the end"
    assert len(text) > tokencounts.AT_ONCE
    docs = spark.createDataFrame([(1, text), (2, "x" * 400_000)], "doc_id long, text string")
    got = {r.doc_id: r.tokens.n_tokens for r in tokencounts.counted(docs, BPE, scratch_path(spark, "test-cache")).collect()}
    assert got == {1: n_tokens(text), 2: n_tokens("x" * 400_000)}
