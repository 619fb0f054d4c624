"""Shards and mixing."""

import zlib

import pytest
from pyspark.sql import functions as F

from obsvar.llm import mixing, shards
from tests.llm.helpers import edge_docs, empty_docs, prose, words


def placed(docs, n=16):
    sized = docs.withColumn("size", shards.text_size()).withColumn("crc", shards.text_crc())
    return shards.balanced_shards(sized, "size", [F.col("doc_id"), F.col("crc")], n)


def test_shards_are_contiguous_gapless_and_near_equal(spark):
    rows = [(k, "y" * (k * 7919 % 900)) for k in range(3_000)] + [(k % 5, "copy") for k in range(1_000)]
    found = placed(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert len(found) == 4_000
    by = {}
    for r in found:
        assert r.size == len(r.text.encode()) + 1 and r.crc == zlib.crc32(r.text.encode())
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == list(range(16))
    totals = []
    last = None
    for s in range(16):
        part = sorted(by[s], key=lambda r: r.slot)
        assert [r.slot for r in part] == list(range(len(part)))
        order = [(r.doc_id, r.crc) for r in part]
        assert order == sorted(order) and (last is None or last <= order[0])
        last = order[-1]
        totals.append(sum(r.size for r in part))
    assert max(totals) - min(totals) <= 2 * 901


def test_shard_edges(spark):
    docs = edge_docs(spark, "slot")
    found = placed(docs, 4)
    assert found.count() == docs.count() and {r[0] for r in found.select("shard").distinct().collect()} <= {0, 1, 2, 3}
    assert placed(empty_docs(spark)).count() == 0
    one = placed(docs.limit(1), 16).collect()
    assert len(one) == 1 and one[0].slot == 0


def level(sizes, weights, cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(cap * sizes[s] for s in stopped)
        target = {s: cap * sizes[s] if s in stopped else left * weight[s] / sum(weight[x] for x in free) for s in names}
        over = {s for s in free if target[s] > cap * sizes[s] + 1e-9}
        if not over:
            return target
        stopped |= over


@pytest.mark.parametrize("split", [True, False])
def test_mix_meets_targets(spark, split):
    rows = [(k, prose(20 + k * 37 % 200, k), "hot" if k % 3 else f"s{k % 11}") for k in range(1_500)]
    rows += [(9_000 + k, prose(30, k), None) for k in range(3)] + [(9_500, "tiny", "a"), (9_501, None, "a"), (9_502, "", "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    found = mixing.mix(docs, split_last=split).select("doc_id", "text", "source", "mix.*").collect()
    sizes = {}
    for r in found:
        assert r.size == len(words(r.text)) and 0 <= r.taken <= 3 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = level(sizes, (1, 2, 3))
    for source, target in want.items():
        mine = [r for r in found if r.source == source]
        assert all(abs(r.target - target) < 1e-6 and r.source_size == sizes[source] for r in mine)
        assert abs(sum(r.taken for r in mine) - target) <= (1 if split else max(r.size for r in mine))
    again = mixing.mix(docs.repartition(3), split_last=split).select("doc_id", "mix.taken").collect()
    assert sorted(map(tuple, again)) == sorted((r.doc_id, r.taken) for r in found)


def test_better_documents_come_first(spark):
    good, bad = [(k, prose(40, k), "s") for k in range(400)], [(1_000 + k, "# % 1 2 3 ! ? " * 6, "s") for k in range(400)]
    docs = spark.createDataFrame(good + bad + [(5_000, prose(16_000, 1), "t")], "doc_id long, text string, source string")
    taken = mixing.mix(docs).filter("source = 's' and mix.taken > 0")
    assert taken.filter("doc_id < 1000").count() > 3 * taken.filter("doc_id >= 1000").count()


def test_mix_edges(spark):
    docs = edge_docs(spark, "mix")
    found = mixing.mix(docs)
    assert found.count() == docs.count()
    twice = mixing.mix(edge_docs(spark)).filter("doc_id = 5").select("mix.taken").collect()
    assert twice[0] == twice[1]
    assert mixing.mix(empty_docs(spark)).count() == 0
    whole = mixing.repeated(edge_docs(spark, "taken"))
    assert whole.columns == edge_docs(spark, "taken").columns and whole.count() > 0
    assert mixing.repeated(docs.filter("text is null")).count() == 0
