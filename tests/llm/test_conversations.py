"""The conversation trie against plain Python dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from obsvar.llm import conversations
from obsvar.llm.listrank import list_ranks

SCHEMA = "conv_id long, turn long, role string, text string"


def digests(role, text):
    said = f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()
    hexes = hashlib.sha256(said).hexdigest()
    return tuple(int.from_bytes(bytes.fromhex(hexes[16 * k : 16 * k + 16]), "big", signed=True) for k in (0, 1))


def sequences(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            held[conv].append((turn is not None, turn or 0, digests(role, text), (role or "", text or "")))
    return {c: [t[3] for t in sorted(ts)] for c, ts in held.items()}


def forked(held, family=20, most=4):
    made = {}
    for c, own in held.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - int(abs(c) % family * (1 if c >= 0 else -1))
        made[c] = held.get(base, [])[:h] + own[h:]
    return made


def brute(made):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        todo, all = [node], []
        while todo:
            all.append(todo.pop())
            todo += children[all[-1]]
        return all

    def words(node):
        return len(node[-1][1].encode().split()) if node else 0

    rows = []
    for node, convs in members.items():
        tree = below(node)
        rows.append(
            (
                min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
                sum(not children[v] for v in tree), sum((len(members[v]) - 1) * words(v) for v in tree),
                hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
            )
        )
    return sorted(rows, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(seed, convs=60, longest=7, vocabulary=3):
    draw = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(draw.randrange(1, longest)):
            rows.append((c - 10, turn, draw.choice(["user", "assistant"]), " ".join("w" * draw.randrange(1, vocabulary) for _ in range(draw.randrange(3)))))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_forks_equal_brute_force(spark, seed):
    rows = table(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(conversations.trie(conversations.forked(frame))) == brute(forked(sequences(rows)))


def test_plain_conversations_with_small_blocks(spark, monkeypatch):
    """Few arcs a block, so that random mates are spliced; hot keys and stretches at small sizes."""
    for name, value in (("HOT_ROWS", 5), ("STRETCH", 3), ("BUCKET", 16)):
        monkeypatch.setattr(conversations, name, value)
    rows = table(3, 40, 12)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(conversations.trie(conversations.as_they_are(frame), block=40)) == brute(sequences(rows))


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "hello  there\x0b you"), (1, 0, "user", "hello  there\x0b you"),
        (1, 1, "a", "bc"), (2, None, "", ""), (2, 0, "user", "hello  there\x0b you"), (2, 1, "ab", "c"),
        (None, 0, "user", "lost"), (None, None, None, None), (3, None, None, ""), (4, 5, "x", "é ü " * 3_000),
        (5, 5, "x", "é ü " * 3_000), (6, 1, "t", "b"), (6, 1, "t", "a"), (23, 0, "user", "one"), (-4, 0, "user", "one"),
    ]
    frame = spark.createDataFrame([(*r, "kept", 1) for r in rows], SCHEMA + ", place string, depth int")
    assert found(conversations.trie(conversations.as_they_are(frame))) == brute(sequences(rows))
    assert found(conversations.trie(conversations.forked(frame))) == brute(forked(sequences(rows)))


def test_no_conversation_no_node(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        frame = spark.createDataFrame(rows, SCHEMA)
        assert conversations.trie(conversations.forked(frame)).collect() == []
        assert conversations.trie(conversations.as_they_are(frame)).collect() == []


def test_one_conversation_and_many_copies(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(4)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert found(conversations.trie(conversations.as_they_are(frame))) == brute(sequences(rows))
    one = [(7, t, "user", f"turn {t}") for t in range(50)]
    frame = spark.createDataFrame(one, SCHEMA)
    assert found(conversations.trie(conversations.as_they_are(frame))) == brute(sequences(one))


@pytest.mark.parametrize("block", [4, 64, 1 << 18])
def test_list_ranks(spark, block):
    """Neighbours far apart in number, as well as runs of them."""
    draw = random.Random(block)
    order = [*range(0, 60)] + draw.sample(range(60, 400), 140)
    links = [(a, b) for a, b in zip(order, [*order[1:], None], strict=True)]
    draw.shuffle(links)
    frame = spark.createDataFrame(links, "arc long, next long").repartition(4)
    assert {r.arc: r.position for r in list_ranks(frame, block).collect()} == {a: k for k, a in enumerate(order)}


def test_empty_list(spark):
    assert list_ranks(spark.createDataFrame([], "arc long, next long")).collect() == []
