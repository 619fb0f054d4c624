from collections import Counter

from obsvar.llm import quality
from tests.llm.helpers import edge_docs, empty_docs, prose, words


def expected(text):
    ws = words(text)
    size = [len(w.decode(errors="replace")) for w in ws]
    out = {"n_words": len(ws), "word_chars": sum(size), "n_symbols": sum(c in "#*$%&|<>" for c in text or "")}
    for n in range(5, 11):
        grams = Counter(tuple(ws[k : k + n]) for k in range(len(ws) - n + 1))
        inside = {p for k in range(len(ws) - n + 1) if grams[tuple(ws[k : k + n])] > 1 for p in range(k, k + n)}
        out[f"dup_{n}_chars"] = sum(size[p] for p in inside)
        if n == 8:
            out["n_repeat_words"] = len(inside)
    seen, again = set(), []
    for line in (text or "").split("\n"):
        if words(line):
            again += [line] * (line in seen)
            seen.add(line)
    out["n_dup_lines"] = len(again)
    out["dup_line_chars"] = sum(len(w.decode()) for line in again for w in words(line))
    return out


def test_measures_equal_brute_force(spark):
    base = prose(60, 1)
    texts = [prose(400, 2), base + "\n" + base, "\n".join([prose(7, k % 3) for k in range(30)]), base + "\n\n" + base + " \n" + base[:90]]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").union(
        edge_docs(spark).filter("doc_id <> 7 or doc_id is null").select("doc_id", "text")
    )
    for row in quality.repetition(docs).select("text", "repetition.*").collect():
        want = expected(row.text)
        assert {k: row[k] for k in want} == want, row.text[:50]


def test_verdicts_and_edges(spark):
    docs = edge_docs(spark, "repetition")
    found = quality.repetition(docs)
    assert found.columns == docs.columns and found.count() == docs.count()
    long = quality.repetition(edge_docs(spark)).filter("doc_id = 7").select("weight", "repetition.*").first()
    assert long.weight == "kept" and long.n_words == long.n_repeat_words == 30_000 and long.base_failed and not long.kept
    clean = spark.createDataFrame([(prose(300, 9, 100_000),), ("good morning " * 15 + prose(80, 4, 10_000),)], "text string")
    verdicts = [(r.base_failed, r.kept) for r in quality.repetition(clean).select("repetition.*").collect()]
    assert verdicts[0] == (False, True) and not verdicts[1][1]
    assert quality.repetition(empty_docs(spark)).count() == 0
