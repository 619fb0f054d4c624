"""Toxicity and language identification."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsvar.llm import langid, toxicity
from tests.llm.helpers import edge_docs, empty_docs, prose

BAD = ["idiot", "scum", "moron", "trash"]


def insulting(k):
    parts = prose(60, k, 2_000).split(" ")
    for j in range(1 + k % 3):
        parts[(7 * j + k) % len(parts)] = BAD[(k + j) % 4] + ("." if k % 2 else "")
    return " ".join(parts)


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(k, insulting(k) if k % 4 == 0 else prose(60, k, 2_000)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(300)] + [(3, None), (None, 1), (5, 7)], "doc_id long, toxic int")
    return docs, labels


@pytest.mark.parametrize("n", [0, 1, 7, 500])
def test_neighbours_are_exact(n):
    draw = np.random.default_rng(n)
    def some(rows):
        m = np.where(draw.random((rows, 40)) < 0.15, draw.random((rows, 40)), 0).astype(np.float32)
        return m / np.maximum(1e-9, np.linalg.norm(m, axis=1, keepdims=True))
    examples, queries = some(n), some(60)
    number, cosine = toxicity.BlockMaxIndex(examples).nearest(queries, 5)
    score = np.rint(queries @ examples.T * 1e5) / 1e5
    for k in range(60):
        want = sorted((-s, j) for j, s in enumerate(score[k]) if s > 0)[:5]
        got = [(-c, j) for j, c in zip(number[k], cosine[k], strict=True) if j >= 0]
        assert len(got) == len(want) and np.allclose([w[0] for w in want], [g[0] for g in got], atol=3e-5)
        assert all(abs(score[k][j] + s) < 3e-5 for s, j in got)


def test_held_out_texts_are_judged_right(labelled):
    docs, labels = labelled
    found = toxicity.scored(docs, toxicity.fit(docs, labels)).filter("doc_id >= 300").select("doc_id", "toxicity.*").collect()
    assert all(0 <= r.score <= 1 for r in found)
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 4 == 0) for r in found]) >= 0.97
    assert all(e % 4 == 0 for r in found if r.score > 0.9 for e in r.evidence)
    left = toxicity.without_toxic(docs, labels)
    assert left.columns == docs.columns and 270 <= left.count() <= 310


def test_toxicity_edges(spark, labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    edges = edge_docs(spark, "toxicity")
    scores = toxicity.scored(edges, model).select("doc_id", "toxicity.score").collect()
    assert len(scores) == edges.count() and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.scored(empty_docs(spark), model).count() == 0
    nothing = toxicity.fit(docs, labels.filter("false"))
    assert {r[0] for r in toxicity.scored(docs, nothing).select("toxicity.score").collect()} == {0.0}
    assert toxicity.without_toxic(edges, labels).count() == edges.count()


SYLLABLES = {"aa": "the ing tion wh ha", "bb": "der ung sch keit ein", "cc": "ción mente ar los que", "dd": "eau oux ent qui ois"}


def spoken(lang, k, n=40):
    draw = np.random.default_rng(k)
    parts = SYLLABLES[lang].split()
    return " ".join("".join(draw.choice(parts, draw.integers(1, 4))) for _ in range(n))


def test_languages(spark):
    rows = [(k, spoken(lang, k), lang) for k in range(200) for lang in SYLLABLES]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs.filter("doc_id < 100").union(docs.limit(1).withColumn("lang", F.lit(None).cast("string"))))
    assert model.langs == sorted(SYLLABLES) and model.code.shape == (4, 7)
    found = langid.identified(docs.filter("doc_id >= 100"), model).select("lang", F.col("language.lang").alias("told"), "language.score").collect()
    assert np.mean([r.lang == r.told for r in found]) > 0.99 and all(0 <= r.score <= 1 for r in found)
    half = spark.createDataFrame([(spoken("aa", 1, 20) + " " + spoken("bb", 2, 20),), ("a",)], "text string")
    assert any(r.ambiguous for r in langid.identified(half, model).select("language.*").collect())


def test_language_edges(spark):
    docs = spark.createDataFrame([(k, spoken("aa", k), "aa") for k in range(20)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    edges = edge_docs(spark, "language")
    found = {r.doc_id: r for r in langid.identified(edges, model).select("doc_id", "language.*").collect() if r.doc_id is not None}
    assert [found[k].lang for k in (1, 2, 3, 9)] == ["und"] * 4 and found[7].lang == "aa" and found[1].score == 0
    assert langid.identified(empty_docs(spark), model).count() == 0
    nothing = langid.fit(empty_docs(spark))
    assert {r[0] for r in langid.identified(edges, nothing).select("language.lang").collect()} == {"und"}


@pytest.mark.parametrize("n", [1, 2, 4, 6, 7, 40])
def test_codewords_are_apart(n):
    code = langid.codewords(n)
    assert len(code) == n and len({tuple(c) for c in code}) == n
    if n >= 4:
        assert min((a != b).sum() for k, a in enumerate(code) for b in code[:k]) >= 3
