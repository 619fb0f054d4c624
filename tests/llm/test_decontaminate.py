from obsvar.llm import decontaminate
from tests.llm.helpers import edge_docs, empty_docs, prose

ITEMS = [(0, prose(37, 100, 5_000)), (1, "Alpha beta, gamma delta; epsilon zeta eta theta iota kappa lambda mu nu xi"), (2, None), (3, "too short"), (None, ""), (1, "Alpha beta, gamma delta; epsilon zeta eta theta iota kappa lambda mu nu xi")]


def inside(passage: str, seed: int) -> str:
    return prose(80, seed, 5_000) + "\n" + passage + ". " + prose(60, seed + 1, 5_000)


def every(text: str, step: int) -> str:
    parts = text.split(" ")
    parts[2::step] = ["other"] * len(parts[2::step])
    return " ".join(parts)


def test_exact_changed_and_partial_passages(spark):
    leak = ITEMS[0][1]
    rows = [
        (1, inside(leak, 1)),
        (2, inside(leak.upper().replace(" ", ",  "), 3)),
        (3, inside(every(leak, 5), 5)),
        (4, inside(" ".join(leak.split()[10:30]), 7)),
        (5, inside(ITEMS[1][1], 9) + " " + leak),
        (6, inside(prose(37, 555, 5_000), 11)),
        (7, inside(every(leak, 2), 13)),
        (8, " ".join(leak.split()[:20])),
        (9, inside(" ".join(leak.split()[:6]), 15)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.contamination(docs, items).collect()}
    assert sorted(found) == [1, 2, 3, 4, 5, 8]
    assert found[1].best_item == 0 and found[1].best_same == 37 and found[1].n_items == 1
    assert found[3].best_same == 30 and found[4].best_same >= 20
    assert found[5].n_items == 2
    left = decontaminate.decontaminated(docs, items)
    assert sorted(r.doc_id for r in left.collect()) == [6, 7, 9] and left.columns == docs.columns


def test_the_other_join_finds_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(k, inside(ITEMS[k % 2][1], k)) for k in range(6)], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    first = sorted(map(tuple, decontaminate.overlaps(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    assert sorted(map(tuple, decontaminate.overlaps(docs, items).collect())) == first and len(first) >= 6


def test_edges(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = edge_docs(spark, "_leak")
    assert decontaminate.decontaminated(docs, items).count() == docs.count()
    word = spark.createDataFrame([(4, "word " * 20), (5, "word " * 30)], "item_id long, text string")
    assert decontaminate.decontaminated(docs, word).filter("doc_id = 7").count() == 0
    assert decontaminate.decontaminated(empty_docs(spark), items).count() == 0
    assert decontaminate.decontaminated(docs, items.filter("false")).count() == docs.count()
    nulls = spark.createDataFrame([(None, inside(ITEMS[0][1], 1)), (None, "clean")], "doc_id long, text string")
    assert decontaminate.decontaminated(nulls, items).count() == 0  # rows that share an id share its verdict


def test_many_shifts_of_repeated_words_and_many_short_items(spark):
    items = [(k, f"{k} too short") for k in range(200)] + [(900, "again and " * 20), (901, "again and " * 21 + "so")]
    docs = [(1, "well " + "again and " * 40), (2, "again so and"), (3, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert [(r.doc_id, r.n_items) for r in found] == [(1, 2)]
    assert found[0].n_overlaps > 60 and found[0].best_same == 42
