import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from obsvar.llm import pii
from tests.llm.helpers import edge_docs, empty_docs, prose

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def expected(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            out += [(m.start(), k, m.end())] if good else []
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


HARD = [
    "a@b.c_d@e.f", "a@b@c.com x..y@z.co.", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3 0255.1.1.001 1.2.3.256",
    "+1 (743) 555-3824 +49-1 22 33 44 55 66x +1+2+3 +12 +", "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111",
    "é😀 mé@x.yz 😀 10.0.0.1 ñ", "1 " * 5_000, "a.b@" * 500 + "c.d", "foo@bar_baz@q.r @a.b a@.b a@b. a@b..c", "a@b" + ".c" * 3_000,
    "12-34 56--78 9", "+1234567890.1.2.3.4", "x@y.z,1.2.3.4,+1 234 567 8901", "mail@x.de " * 700, "", None, "nothing here",
]


def test_base_spans_equal_the_plain_patterns(spark):
    docs = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    found = pii.base_spans(docs).select("doc_id", pii.rendered(F.col("spans"))).collect()
    assert {k: v for k, v in found} == {k: expected(t) for k, t in enumerate(HARD)}


def test_disclosing_terms(spark):
    rows = [(k, f"{prose(30, k, 3_000)} please ask {prose(2, k + 500)} at boss@corp.example or Zorblatt now {prose(20, k)}") for k in range(12)]
    rows = [(k, t if k % 2 else t.replace("Zorblatt", "zorblatt")) for k, t in rows]
    rows += [(100 + k, prose(60, k + 900, 3_000) + " please ask at or now") for k in range(300)]
    rows += [(900, "a note on Zorblatt, alone"), (901, rows[0][1]), (902, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {r.term: r for r in pii.disclosing_terms(docs).collect()}
    # of 313 distinct texts 12 have the entity, all of them with the term, which one more text has
    degree = 1 + math.log(12 / 13) / math.log(313 / 12)
    assert list(terms) == ["zorblatt"] and abs(terms["zorblatt"].disclosure - degree) < 1e-12
    assert pii.GENERALISE < pii.REMOVE <= degree and terms["zorblatt"].action == "remove"
    found = {r.doc_id: r for r in pii.protected(docs, carry_text=True).withColumn("clean", pii.sanitised(F.col("text"), F.col("all"))).collect()}
    assert len(found) == len(rows)
    alone = found[900]
    assert [(s.start, s.end, s.value) for s in alone["all"]] == [(10, 18, "Zorblatt")] and alone.base == []
    assert alone.clean == "a note on [TERM], alone"
    assert "[EMAIL]" in found[3].clean and "boss" not in found[3].clean and "orblatt" not in found[3].clean
    assert all(set(r.base) <= set(r["all"]) for r in found.values())


def test_copies_are_one_witness(spark):
    text = prose(30, 1, 9_000) + " quixotic boss@corp.example villa " + prose(20, 2, 9_000)
    docs = spark.createDataFrame([(k, text) for k in range(40)] + [(100 + k, prose(50, k)) for k in range(100)], "doc_id long, text string")
    assert pii.disclosing_terms(docs).count() == 0


def test_copies_of_a_holder_leave_its_term_flagged(spark):
    rows = [(k, f"{prose(30, k, 3_000)} boss@corp.example Zorblatt {prose(20, k + 50)}") for k in range(12)]
    rows += [(100 + k, prose(60, k + 900, 3_000)) for k in range(300)]
    rows += [(1_000 + k, rows[0][1]) for k in range(400)]
    terms = {r.term: r for r in pii.disclosing_terms(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert terms["zorblatt"].disclosure == 1.0 and terms["zorblatt"].action == "remove"


def test_terms_far_from_the_entity_count(spark):
    rows = [(k, f"Zorblatt {prose(30, k, 3_000)} boss@corp.example {prose(20, k + 50)} " + "Quuxham" * (k % 2)) for k in range(12)]
    rows += [(100 + k, prose(60, k + 900, 3_000)) for k in range(300)]
    terms = {r.term: r for r in pii.disclosing_terms(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert terms["zorblatt"].disclosure == 1.0 and not {"boss", "corp", "example"} & set(terms)
    assert terms["quuxham"].disclosure == 1.0  # at the foot of half of the texts, and nowhere else


def test_edges(spark):
    docs = edge_docs(spark, "base")
    found = pii.protected(docs)
    assert found.count() == docs.count()
    spans = {r.doc_id: pii_text for r, pii_text in ((r, r.base) for r in found.collect())}
    assert spans[1] == [] and len(spans[9]) == 4_000
    assert pii.protected(empty_docs(spark)).count() == 0


def brute_terms(texts):
    """Disclosure of every term by counting in dictionaries, as the module's formula says."""
    texts, n_e, n_et, n_t = set(texts), Counter(), Counter(), Counter()
    for text in texts:
        n_t.update(set(re.split(r"[^a-z0-9]+", text.lower())) - {""})
        spans = [s.split(":") for s in expected(text).split(",") if s]
        for kind in {s[0] for s in spans}:
            mine = [(int(a), int(b)) for k, a, b in spans if k == kind]
            entities = {text[a:b].lower() for a, b in mine}
            bare, last = [], 0
            for a, b in mine:
                bare += [text[last:a], " "]
                last = b
            terms = set(re.split(r"[^a-z0-9]+", ("".join(bare) + text[last:]).lower())) - {""}
            n_e.update(entities)
            n_et.update((e, t) for e in entities for t in terms)
    found = {}
    for (e, t), n in n_et.items():
        if n >= pii.SUPPORT and n_e[e] >= pii.SUPPORT and n_t[t]:
            degree = 1 + math.log(min(1, n / n_t[t])) / math.log(len(texts) / n_e[e])
            if degree >= pii.GENERALISE:
                found[t] = max(degree, found.get(t, 0))
    return found


def test_terms_equal_brute_force(spark):
    draw = random.Random(5)
    mails = [f"m{k}@corp{k % 3}.example" for k in range(6)] + ["10.0.0.7", "+1 743 555 3824"]
    texts = []
    for k in range(260):
        words = prose(25, k, 900).split()
        for e in draw.sample(range(8), draw.choice([0, 0, 0, 1, 2])):
            words.insert(draw.randrange(len(words)), mails[e])
            if draw.random() < 0.9:
                words.insert(draw.randrange(len(words)), f"secret{e}")
        if draw.random() < 0.02:
            words.append(f"secret{draw.randrange(8)}")
        texts.append(" ".join(words))
    texts += texts[:40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.term: r.disclosure for r in pii.disclosing_terms(docs).collect()}
    want = brute_terms(texts)
    assert len(want) >= 5 and found.keys() == want.keys()
    assert all(abs(found[t] - d) < 1e-9 for t, d in want.items())
