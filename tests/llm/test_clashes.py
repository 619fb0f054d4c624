"""Columns of the caller that are called like an operator's own helpers."""

import pytest
from pyspark.sql import functions as F

from obsvar.llm import mixing, pii, stages, tokencounts, urlgraph

from .helpers import prose

HELPERS = ["target", "share", "last", "epochs", "rest", "source_size", "_m", "_mix", "_found", "_at_source", "_copy", "_source", "size", "key", "tie"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, prose(20 + k, k), f"s{k % 3}") for k in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def shown(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_mixing(docs):
    clashing = docs.withColumns({c: F.lit(f"my {c}") for c in HELPERS})
    mixed = mixing.mix(clashing)
    assert mixed.columns == [*clashing.columns, "mix"]
    assert shown(mixed, "doc_id", "mix.*") == shown(mixing.mix(docs), "doc_id", "mix.*")
    assert mixed.filter(" and ".join(f"`{c}` = 'my {c}'" for c in HELPERS)).count() == 40
    again = mixing.repeated(clashing)
    assert again.columns == clashing.columns and shown(again, "doc_id") == shown(mixing.repeated(docs), "doc_id")


def test_url_graph(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", "", "mine", 5)], "page_id long, url string, html string, _rule string, _blocked long")
    found = urlgraph.judged(pages, [urlgraph.Rule("block", "net", "/")]).first()
    assert (found._rule, found._blocked, found.rule, found.verdict) == ("mine", 5, "net/", "block")


def test_near_copies_stage(spark):
    text = prose(60, 1)
    rows = [(1, text, 7), (2, text, 8), (None, text, 9), (3, prose(60, 2), 1), (1, prose(40, 5), 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gone long")
    kept = stages.near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r._gone) for r in kept.collect()) == [(0, 9), (1, 3), (1, 7), (3, 1)]


def test_personal_data_raises(docs):
    with pytest.raises(ValueError, match="_h_email"):
        pii.base_spans(docs.withColumn("_h_email", F.lit(1)))


def test_token_counts(spark, docs, tmp_path):
    import public_tokenizers

    clashing = docs.withColumns({c: F.lit(1) for c in ("_digest", "_n_tokens", "_n_bytes", "digest", "tokenizer", "n_tokens")})
    found = tokencounts.counted(clashing, public_tokenizers.path("byte_bpe_50k.json"), f"{tmp_path}/cache")
    assert found.columns == [*clashing.columns, "tokens"] and found.filter("tokens.n_tokens > 0 and n_tokens = 1").count() == 40
