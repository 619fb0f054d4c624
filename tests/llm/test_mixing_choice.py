"""Which documents a mix takes, by the keys that they have drawn, in plain Python."""

import math
from collections import defaultdict

from obsvar.llm import mixing

from .helpers import prose


def half_up(x: float) -> int:
    return math.floor(x + 0.5)


def test_choice_by_keys_equals_brute_force(spark):
    rows = [(k, prose(5 + k * 7 % 60, k), ["a", "b", "c", None][k * k % 4 if k % 3 else 3]) for k in range(200)]
    rows += [(k, t, s) for k, t, s in rows[:5]] + [(900, None, "a"), (901, "", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    drawn = mixing._drawn(docs, "doc_id", "text", 8, "own").select("doc_id", "source", "own.*").collect()
    taken = defaultdict(list)
    known = {}
    for r in mixing.mix(docs).collect():
        taken[r.doc_id, r.source].append(r.mix.taken)
        known[r.source] = (r.mix.source_size, r.mix.target)
    want = defaultdict(list)
    for source, (size, target) in known.items():
        mine = sorted((r for r in drawn if r.source == source), key=lambda r: (r.key, r.tie))
        assert sum(r.size for r in mine) == size
        epochs = math.floor(target / size)
        rest, before, last, cut = half_up(target - epochs * size), 0, None, 0
        for r in mine:
            if before < rest and r.size > 0:
                if last != (r.key, r.tie):
                    last, cut = (r.key, r.tie), before
            before += r.size
        at_end = sum(r.size for r in mine if (r.key, r.tie) == last)
        for r in mine:
            now = (r.key, r.tie)
            share = min(1.0, (rest - cut) / at_end) if at_end else 0
            more = r.size if last and now < last else half_up(r.size * share) if now == last else 0
            want[r.doc_id, source].append(epochs * r.size + more)
    assert {k: sorted(v) for k, v in taken.items()} == {k: sorted(v) for k, v in want.items()}
