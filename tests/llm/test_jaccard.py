import random
from collections import defaultdict

import pytest

from obsvar.llm import jaccard
from obsvar.llm.components import components
from tests.llm.helpers import copy_with_edits, edge_docs, empty_docs, prose

FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def sets_of(rows, n):
    out = []
    for _, text in rows:
        w = (text or "").encode().translate(FOLD).split()
        out.append(frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    return out


def expected(rows, n, percent):
    sets, parent = sets_of(rows, n), list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    least = defaultdict(list)
    for a, (id, _) in enumerate(rows):
        least[find(a)].append(id)
    return sorted((id, len(sets[a]), min(least[find(a)])) for a, (id, _) in enumerate(rows))


def corpus(seed):
    draw, rows = random.Random(seed), []
    for base in range(6):  # chains and stars of edited copies, some of edited copies
        text = prose(draw.choice([20, 60, 150]), seed * 100 + base, 5_000)
        family = [text]
        for k in range(25):
            family.append(copy_with_edits(draw.choice(family), draw.choice([0, 1, 1, 2, 3]), seed * 1_000 + base * 50 + k))
        family += [" ".join(t.split(" ")[: -draw.choice([1, 2, 5])]) for t in family[:6]]
        rows += family
    passage = prose(40, 77, 5_000)
    rows += [prose(60, 300 + k, 5_000) + " " + passage for k in range(40)]
    rows += [passage + " " + prose(3, 400 + k, 5_000) for k in range(25)]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("n", "percent", "seed"), [(4, 85, 1), (5, 80, 2)])
def test_components_equal_brute_force(spark, n, percent, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, jaccard.similar_groups(docs, n, percent).collect()))
    want = expected(rows, n, percent)
    assert found == want
    assert 10 < len({c for _, _, c in want}) < len(rows) - 50


def hub_families(count, n, percent):
    """Families x, y, z: only x and y are similar; z has a frequent notice, and so is the hub of what they share."""
    notice, rows = " ".join(f"notice{k}" for k in range(13)), []
    rows += [f"{prose(50, 9_000 + k, 100_000)} {notice}" for k in range(40)]
    for f in range(count):
        body = " ".join(f"f{f}b{k}" for k in range(85 + n))
        more = {side: " ".join(f"f{f}{side}{k}" for k in range(size)) for side, size in (("y", 14 if percent == 85 else 21), ("z", 10))}
        rows += [body, f"{body} {more['y']}", f"{body} {more['z']} {notice}"]
    return list(enumerate(rows))


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_pairs_whose_hub_is_dissimilar_equal_brute_force(spark, n, percent):
    rows = hub_families(12, n, percent)
    found = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), n, percent).collect()
    want = expected(rows, n, percent)
    assert len({c for _, _, c in want}) <= len(rows) - 12
    assert sorted(map(tuple, found)) == want


def test_edges(spark):
    found = jaccard.similar_groups(edge_docs(spark, "id"), 4, 85).collect()
    assert len(found) == len(edge_docs(spark).collect())
    by = defaultdict(list)
    for r in found:
        by[r.doc_id].append((r.n_shingles, r.component_id))
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)]
    assert by[5] == [(1, 5), (1, 5)] and by[6] == [(1, 5)] and by[7] == [(1, 7)]
    assert sorted(by[None]) == [(0, None), (2, None)] and by[-4] == [(4, -4)]
    assert jaccard.similar_groups(empty_docs(spark)).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(159, 200), (7, 7)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len(found) == 61 + 61
    first, second = {found[k] for k in range(61)}, {found[k] for k in [*range(100, 160), 200]}
    assert len(first) == len(second) == 1 and first <= set(range(61)) and second <= {*range(100, 160), 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
