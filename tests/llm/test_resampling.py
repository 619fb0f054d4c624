"""Importance resampling and its radix sort against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsvar.llm import resampling
from obsvar.llm.radix import Key, radix_sorted
from obsvar.session import written

from .helpers import EDGES, edge_docs, empty_docs, prose

LOWER = {c: c + 32 for c in range(65, 91)}


def grams(text, runs):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent=10, min_words=20, runs=1, buckets=10_000, seed=2024):
    def slot(gram):
        return zlib.crc32(gram.encode()) % buckets

    raw = Counter(slot(g) for _, t in docs for g in grams(t, runs)[1])
    aim = Counter(slot(g) for t in target for g in grams(t, runs)[1])
    s, t = sum(raw.values()), sum(aim.values())

    def gain(b):
        return math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets))))

    rows = []
    for id, text in docs:
        n, found = grams(text, runs)
        weight = sum(gain(slot(g)) for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([id, n, len(found), weight, score, None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: percent * len(able) // 100]):
        row[5] = place + 1
    return sorted((tuple(r) for r in rows), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("runs", [1, 3])
def test_equals_brute_force(spark, runs):
    docs = [(k * 7 - 300, prose(5 + k % 60, k) + " Ünï-CODE's 3x " + "y" * (k % 90)) for k in range(300)]
    target = [prose(40, 10_000 + k, 40) for k in range(20)] + [None, ""]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    got = found(resampling.ranked(frame, aims, percent=30, runs=runs, block=16, width=3))
    assert got == brute(docs, target, percent=30, runs=runs)


def test_edges_nulls_repeats_and_clashes(spark):
    docs = edge_docs(spark, "place")
    aims = spark.createDataFrame([("word same one",)], "text string")
    got = found(resampling.ranked(docs, aims, percent=50, min_words=1))
    want = brute([(r[0], r[1]) for r in EDGES], ["word same one"], percent=50, min_words=1)
    assert got == want
    kept = resampling.resampled(docs, aims, percent=50, min_words=1)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in want if r[5]}


def test_empty_tables(spark):
    aims = spark.createDataFrame([], "text string")
    assert resampling.ranked(empty_docs(spark), aims).collect() == []
    docs = [(k, prose(30, k)) for k in range(30)]
    got = found(resampling.ranked(spark.createDataFrame(docs, "doc_id long, text string"), aims))
    assert got == brute(docs, [])


def test_text_ids_are_refused(spark):
    docs = spark.createDataFrame([("a", "b")], "doc_id string, text string")
    with pytest.raises(TypeError, match="whole numbers"):
        resampling.ranked(docs, docs)


def test_ids_over_the_whole_range_of_longs(spark):
    docs = [(k, "one text " * 12) for k in (-(1 << 63), (1 << 63) - 1, 0, -1, 5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(resampling.ranked(frame, frame, percent=100)) == brute(docs, [t for _, t in docs], percent=100)


def test_crcs_of_short_and_long_ranges():
    draw = random.Random(3)
    parts = [bytes(draw.randrange(256) for _ in range(n)) for n in (1, 2, 3, 64, 65, 1_000, 7, 1)]
    ends = np.cumsum([len(p) for p in parts])
    got = resampling.crcs(np.frombuffer(b"".join(parts), np.uint8), np.append(0, ends[:-1]), ends)
    assert [int(c) for c in got] == [zlib.crc32(p) for p in parts]


@pytest.mark.parametrize("block,width", [(8, 2), (64, 5), (1 << 18, 12)])
def test_radix_sort_is_stable_at_any_block_and_digit(spark, block, width):
    draw = random.Random(block)
    rows = [(draw.choice([0, 0, 0, 5, 900]), draw.randrange(1 << 20), k) for k in range(500)]
    frame = spark.createDataFrame(rows, "a long, b long, was long").repartition(7)
    frame = frame.withColumn("place", F.col("was") * 3)  # gaps do no harm
    stored, _ = written(frame, "test-radix")
    done, _ = radix_sorted(stored, [Key("a", 10)], "place", block, width)
    got = [r.was for r in done.orderBy("place").collect()]
    assert got == [r[2] for r in sorted(rows, key=lambda r: r[0])]
    done, _ = radix_sorted(stored, [Key("b", 20), Key("a", 10)], "place", block, width)
    ranked = done.orderBy("place").collect()
    assert [r.place for r in ranked] == list(range(500))
    assert [(r.a, r.b, r.was) for r in ranked] == sorted(rows)
