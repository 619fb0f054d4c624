import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsvar.llm import lm
from obsvar.llm.eliasfano import Codebook, EliasFano, Trie, mapped
from tests.llm.helpers import edge_docs, empty_docs, prose

FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


@pytest.mark.parametrize(("n", "top"), [(0, 1), (1, 1), (1, 2**64), (500, 600), (3_000, 2**32), (2_000, 2**64), (400, 10**6)])
def test_elias_fano_round_trip_and_search(n, top):
    draw = np.random.default_rng(n)
    values = np.unique(draw.integers(0, top, n, dtype=np.uint64, endpoint=False))
    parts, size, bits = EliasFano.encode(values, "x")
    coded = EliasFano(mapped(parts), size, bits, "x")
    if size:
        assert (coded.get(np.arange(size)) == values).all()
    asked = np.concatenate((values, draw.integers(0, top, 500, dtype=np.uint64, endpoint=False)))
    place = {int(v): k for k, v in enumerate(values)}
    assert coded.find(asked).tolist() == [place.get(int(v), -1) for v in asked]


def test_trie_look_up():
    draw = np.random.default_rng(5)
    contexts = np.unique(draw.integers(0, 2**64, 300, dtype=np.uint64))
    pairs = np.unique(np.stack((draw.integers(0, len(contexts) - 3, 4_000), draw.integers(0, 50, 4_000))), axis=1)
    score, backoff = -draw.random(pairs.shape[1]), -draw.random(len(contexts))
    trie = Trie(contexts, backoff, pairs[0], pairs[1].astype(np.uint64), score)
    known = {(int(contexts[c]), int(w)): s for c, w, s in zip(*pairs, score, strict=True)}
    asked = [(int(c), w) for c in contexts[:290] for w in range(0, 60, 7)] + [(12345, 1)]
    out, seen, there = trie.look_up(np.array([a for a, _ in asked], np.uint64), np.array([w for _, w in asked], np.uint64))
    for k, (c, w) in enumerate(asked):
        if c == 12345:
            assert not there[k] and not seen[k] and out[k] == 0
        else:
            want = known.get((c, w), backoff[np.searchsorted(contexts, np.uint64(c))])
            assert seen[k] == ((c, w) in known) and abs(out[k] - want) < 0.02
    assert (Codebook.encode(np.array([1.0, 1.0]))[1] == 0).all()


def reference(rows, train):
    low = {k: (t or "").encode().translate(FOLD).split() + [None] for k, t in rows}
    count = Counter(w for k, ws in low.items() if k in train for w in ws)
    n, v = sum(count.values()), len(count)
    return {k: (len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for k, ws in low.items()}


def test_base_scores_and_model(spark):
    def chain(k):  # a word is mostly followed by one of two
        words = [k % 97]
        for step in range(80):
            words.append((words[-1] * 5 + (k * 31 + step * 17) % 2 + 1) % 97)
        return " ".join(f"W{w}" for w in words) + f" only{k}"

    rows = [(k, chain(k)) for k in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = lm.scored(docs, F.col("doc_id") % 5 != 1).collect()
    want = reference(rows, {k for k, _ in rows if k % 5 != 1})
    assert len(found) == len(rows)
    for r in found:
        tokens, known, n, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, n) and abs(r.base_score - base) < 1e-6
        assert r.score <= 0 and r.train == (r.doc_id % 5 != 1)
    held = [r for r in found if not r.train]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    again = {r.doc_id: r.score for r in lm.scored(docs.repartition(5), F.col("doc_id") % 5 != 1).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-3 * (1 - r.score) for r in found)


def test_the_probabilities_of_all_words_do_not_exceed_one(spark):
    rows = [(k, prose(60, k, 25)) for k in range(60)]
    vocabulary = sorted({w for _, t in rows for w in t.split()})
    asked = [(1_000 + k, f"w3 {w}") for k, w in enumerate([*vocabulary, "unknown"])] + [(5_000, "w3")]
    docs = spark.createDataFrame(rows + asked, "doc_id long, text string")
    found = {r.doc_id: r.score for r in lm.scored(docs, F.col("doc_id") < 1_000).filter("doc_id >= 1000").collect()}
    ends = {r.doc_id: r.score for r in lm.scored(spark.createDataFrame(rows + [(2_000 + k, w) for k, w in enumerate([*vocabulary, "unknown"])], "doc_id long, text string"), F.col("doc_id") < 1_000).filter("doc_id >= 2000").collect()}
    # log p(w3 w end) - log p(w end) + log p(w | begin) would need each part; bound the sum over texts instead
    assert sum(10**s for s in ends.values()) < 1 and sum(10 ** found[1_000 + k] for k in range(len(vocabulary) + 1)) < 1


def test_edges(spark):
    docs = edge_docs(spark, "train")
    found = lm.scored(docs, F.col("doc_id") > 4).collect()
    assert len(found) == docs.count() and sum(r.doc_id is None for r in found) == 2
    by = {r.doc_id: r for r in found}
    assert by[1].n_tokens == by[2].n_tokens == by[3].n_tokens == 1 and by[7].n_tokens == 30_001
    assert lm.scored(empty_docs(spark), F.col("doc_id") > 0).count() == 0
    none = lm.scored(docs, F.lit(False)).collect()
    assert {r.score for r in none} == {0.0} and {r.train_tokens for r in none} == {0} and {r.n_known for r in none} == {0}
