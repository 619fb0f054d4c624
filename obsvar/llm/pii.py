"""Personal data: spans by pattern, and terms that disclose them, in DataFrame functions only.

Information-theoretic sanitisation: a term discloses a protected entity as far as seeing the term
tells that the entity is there. With counts n over the corpus of N documents that is
PMI(e; t) / IC(e) = 1 + log(n(e, t) / n(t)) / log(N / n(e)). Terms beyond one threshold are
generalised, beyond a higher one removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsvar.session import discard, materialise, written

KINDS = ("email", "ip", "card", "phone")
#: Possessive and guarded forms: no backtracking, no recursion, the same leftmost matches.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without this has no match; checked before the patterns run.
NEEDS = {"email": "@", "ip": None, "card": None, "phone": "+"}
SUPPORT = 3  # distinct texts that must hold a term and an entity
GENERALISE, REMOVE = 0.85, 0.95
WORD_BREAK = r"[^\p{L}\p{N}]+"
#: Terms up to this number are broadcast (some 40 bytes each); more meet the words in a shuffle.
BROADCAST_TERMS = 400_000
BROADCAST_DOCS = 200_000
PREFIX_BLOCK = 128
SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _last_sums(values: Column) -> Column:
    """Running sums of an int array, in blocks so that long arrays do not cost their square."""

    def run(part: Column, begin: Column) -> Column:
        empty = F.struct(begin.alias("s"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            part,
            empty,
            lambda acc, x: F.struct((acc.s + x).alias("s"), F.concat(acc.out, F.array(acc.s + x)).alias("out")),
        )

    count = F.ceil(F.size(values) / PREFIX_BLOCK).cast("int")
    parts = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(values, b * PREFIX_BLOCK + 1, PREFIX_BLOCK))
    none = F.struct(F.lit(0).alias("s"), F.array().cast("array<array<int>>").alias("out"))

    def step(acc: Column, part: Column) -> Column:
        done = F.transform(F.array(run(part, acc.s)), lambda r: F.struct(r.s.alias("s"), F.concat(acc.out, F.array(r.out)).alias("out")))
        return F.element_at(done, 1)

    return F.flatten(F.aggregate(parts, none, step).out)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        def small(part: Column) -> Column:
            bare = F.ltrim(part, F.lit("0"))
            return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _free(docs: DataFrame) -> DataFrame:
    """``docs``; raises if a column is called like one of the helper columns, which would vanish."""
    taken = sorted({c for c in docs.columns if c.lower() in {f"_{x}_{k}" for x in "hpes" for k in KINDS}})
    if taken:
        raise ValueError(f"columns {', '.join(taken)} have names that are needed here: rename them")
    return docs


def _cut(docs: DataFrame, text: str) -> DataFrame:
    """Adds for each kind the matches (``_h``) and the text between them (``_p``)."""
    body = F.coalesce(F.col(text), F.lit(""))
    numeric = body.rlike("[0-9]")
    for kind in KINDS:
        possible = body.contains(NEEDS[kind]) & numeric if kind == "phone" else body.contains("@") if kind == "email" else numeric
        hits = F.when(possible, F.regexp_extract_all(body, F.lit(PATTERNS[kind]), F.lit(0)))
        docs = docs.withColumn(f"_h_{kind}", hits)
    for kind in KINDS:
        docs = docs.withColumn(f"_p_{kind}", F.when(F.size(f"_h_{kind}") > 0, F.split(body, PATTERNS[kind], -1)))
    return docs


def _ends(hits: Column, pieces: Column) -> Column:
    """Where each part ends: piece, match, piece, match, ...; match k begins at place 2k, ends at 2k + 1.

    To be stored as a column before it is used in a lambda: there it would be made anew each time.
    """
    lengths = F.zip_with(F.slice(pieces, 1, F.size(hits)), hits, lambda p, h: F.array(F.length(p), F.length(h)))
    return F.when(F.size(pieces) > 1, _last_sums(F.flatten(lengths)))


def _located(hits: Column, ends: Column, kind: int) -> Column:
    """Spans of the matches of one kind, in order of their starts."""
    spans = F.transform(
        hits,
        lambda h, k: F.struct(
            F.get(ends, 2 * k).alias("start"), F.lit(kind).alias("kind"), F.get(ends, 2 * k + 1).alias("end"), h.alias("value")
        ),
    )
    return F.when(ends.isNotNull(), spans).otherwise(F.array()).cast(SPANS)


def base_spans(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with ``out``: the spans of the four patterns by start, then kind.

    Offsets are code points, ends exclusive; kinds are places in ``KINDS``. A null text is empty.
    Matches are leftmost and do not overlap within a kind; one that fails its check is dropped and
    nothing inside it is tried. Columns called like helper columns (``_h_email`` and alike) raise.
    """
    found = _cut(_free(docs), text)
    for kind in KINDS:
        found = found.withColumn(f"_e_{kind}", _ends(F.col(f"_h_{kind}"), F.col(f"_p_{kind}")))

    def valid(k: int, kind: str) -> Column:
        return F.filter(_located(F.col(f"_h_{kind}"), F.col(f"_e_{kind}"), k), lambda s: _valid(kind, s.value))

    for k, kind in enumerate(KINDS):
        found = found.withColumn(f"_s_{kind}", valid(k, kind))
    everything = F.array_sort(F.concat(*(F.col(f"_s_{kind}") for kind in KINDS)))
    extra = [f"_{x}_{kind}" for x in "hpes" for kind in KINDS]
    return found.withColumn(out, everything).drop(*extra)


def _held(docs: DataFrame, text: str) -> DataFrame:
    """(print, held) of each text: for a kind with valid matches these, and the words outside them."""
    found = _cut(docs, text)

    def outside(kind: str) -> Column:
        hits, pieces = F.col(f"_h_{kind}"), F.col(f"_p_{kind}")
        # a valid match ends a word; one that fails its check is text like any other
        filled = F.zip_with(F.slice(pieces, 1, F.size(hits)), hits, lambda p, h: F.concat(p, F.when(_valid(kind, h), " ").otherwise(h)))
        whole = F.array_join(F.concat(filled, F.array(F.element_at(pieces, -1))), "")
        return F.array_distinct(F.array_remove(F.split(F.lower(whole), WORD_BREAK), ""))

    def held(k: int, kind: str) -> Column:
        valid = F.filter(F.col(f"_h_{kind}"), lambda h: _valid(kind, h))
        entities = F.array_distinct(F.transform(valid, lambda h: F.lower(h)))
        return F.when(F.size(valid) > 0, F.struct(F.lit(k).alias("kind"), entities.alias("entities"), outside(kind).alias("terms")))

    every = F.array_compact(F.array(*(held(k, kind) for k, kind in enumerate(KINDS))))
    return found.select(F.xxhash64(F.col(text)).alias("print"), every.alias("held")).filter(F.size("held") > 0)


def _holders(docs: DataFrame, text: str, pairs: DataFrame) -> DataFrame:
    """(term, n): how many distinct texts hold each term of ``pairs``."""
    asked = pairs.select("term").distinct()
    small = F.broadcast if asked.count() <= BROADCAST_TERMS else (lambda df: df)
    split = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WORD_BREAK))
    words = docs.select(F.xxhash64(text).alias("print"), F.explode(split).alias("term")).join(small(asked), "term")
    return words.select("print", "term").distinct().groupBy("term").agg(F.count("*").alias("n"))


def disclosing_terms(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(term, disclosure, action): what gives a protected entity of the corpus away.

    All four counts are those of distinct texts, so that copies of a text are one witness; a term and
    an entity meet wherever in a text they stand. Single documents prove nothing: a term needs
    ``SUPPORT`` texts with an entity. An entity or term that fills most of the corpus is reduced
    within partitions before it is shuffled.
    """
    spark = docs.sparkSession
    places, path = written(_held(docs, text).dropDuplicates(["print"]), "held")
    total = max(2, docs.select(F.xxhash64(text)).distinct().count())
    by_kind = places.select("print", F.explode("held").alias("m")).select("print", "m.*")
    found = by_kind.select("print", "kind", F.explode("entities").alias("entity"))
    entities = found.groupBy("entity").agg(F.count("*").alias("n_e")).filter(F.col("n_e") >= SUPPORT)
    entities, entities_at = written(entities, "entities")

    def most(n_et: Column, n_e: Column) -> Column:
        return n_et * F.pow(F.lit(float(total)) / n_e, F.lit(1 - GENERALISE)) * (1 + 1e-9)

    # the supported entities of a text go to its row, and all that follows stays inside rows
    known = found.join(entities, "entity").groupBy("print")
    known = known.agg(F.collect_list(F.struct("kind", "entity", "n_e")).alias("known"), F.max("n_e").alias("top"))
    texts, texts_at = written(places.join(known, "print", "left"), "texts")
    discard(spark, path)
    # texts with the term and any entity: no more than all that have it, and often too many already
    # for any entity that it meets: of these none stands with it in more texts than it meets one in,
    # nor in more than the most frequent has itself; counted within partitions first
    words = texts.select(F.explode(F.array_distinct(F.flatten("held.terms"))).alias("term"), "top")
    near = words.groupBy("term").agg(F.count("*").alias("n_near"), F.count("top").alias("n_met"), F.max("top").alias("top"))
    together = F.least("n_met", "top")
    near = near.filter((F.col("n_met") >= SUPPORT) & (F.col("n_near") <= most(together, together)))
    near, near_at = written(near.select("term", "n_near"), "near")
    small = F.broadcast if near.count() <= BROADCAST_TERMS else (lambda df: df)
    met = texts.filter("known is not null").select("known", F.explode("held").alias("m"))
    mine = F.filter("known", lambda e: e.kind == F.col("m.kind"))
    terms = met.select(mine.alias("known"), F.explode("m.terms").alias("term")).filter(F.size("known") > 0).join(small(near), "term")
    fitting = F.filter("known", lambda e: F.col("n_near") <= most(e.n_e, e.n_e))
    pairs = terms.select("term", "n_near", F.explode(fitting).alias("e")).groupBy("e.entity", "term")
    pairs = pairs.agg(F.count("*").alias("n_et"), F.max("e.n_e").alias("n_e"), F.max("n_near").alias("n_near"))
    pairs = pairs.filter((F.col("n_et") >= SUPPORT) & (F.col("n_near") <= most(F.col("n_et"), F.col("n_e"))))
    pairs = materialise(pairs.drop("n_near"))
    discard(spark, texts_at, entities_at, near_at)
    # all texts that have the terms: first in a quarter of them, by hash, as most terms are in too
    # many of these already and need no more counting
    one, other = (F.xxhash64(text).bitwiseAND(3) == 0), (F.xxhash64(text).bitwiseAND(3) != 0)
    pairs = pairs.join(_holders(docs.filter(one), text, pairs).withColumnRenamed("n", "n_one"), "term", "left")
    pairs = materialise(pairs.fillna(0, ["n_one"]).filter(F.col("n_one") <= most(F.col("n_et"), F.col("n_e"))))
    pairs = pairs.join(_holders(docs.filter(other), text, pairs).withColumnRenamed("n", "n_other"), "term", "left")
    pairs = pairs.fillna(0, ["n_other"]).withColumn("n_t", F.col("n_one") + F.col("n_other")).filter("n_t > 0")
    told = F.log2(F.lit(float(total)) / F.col("n_e"))
    share = F.least(F.lit(1.0), F.col("n_et") / F.col("n_t"))
    degree = F.when(told > 0, 1 + F.log2(share) / told)
    found = pairs.withColumn("disclosure", degree).groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    action = F.when(F.col("disclosure") >= REMOVE, "remove").otherwise("generalise")
    return materialise(found.filter(F.col("disclosure") >= GENERALISE).withColumn("action", action))


def term_spans(docs: DataFrame, terms: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, print, term_spans) of the texts that hold a disclosing term; ``print`` hashes the text.

    Terms are whole words, in any case. Rows that repeat id and text are there once.
    """
    n = terms.count()
    small = F.broadcast if n <= BROADCAST_TERMS else (lambda df: df)
    kept = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"), F.xxhash64(F.col(text)).alias("_print"))
    words = kept.select("_id", "_print", F.explode(F.array_distinct(F.split(F.lower("_text"), WORD_BREAK))).alias("term"))
    holders = words.join(small(terms.select("term")), "term").groupBy("_id", "_print").agg(F.collect_set("term").alias("_terms"))
    holders = materialise(holders.withColumnRenamed("_id", "_i").withColumnRenamed("_print", "_hash"))
    few = F.broadcast if holders.count() <= BROADCAST_DOCS else (lambda df: df)
    rows = kept.join(few(holders), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_print") == F.col("_hash")))
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join("_terms", "|"), F.lit(r")(?![\p{L}\p{N}])"))
    rows = rows.withColumn("_h", F.regexp_extract_all("_text", pattern, F.lit(0)))
    rows = rows.withColumn("_p", F.split(F.col("_text"), pattern, -1))
    rows = rows.select("_id", "_print", "_h", _ends(F.col("_h"), F.col("_p")).alias("_e")).filter("_e is not null")
    found = rows.select("_id", "_print", _located(F.col("_h"), F.col("_e"), len(KINDS)).alias("_term_spans"))
    return found.dropDuplicates(["_id", "_print"])


def protected(docs: DataFrame, id: str = "doc_id", text: str = "text", carry_text: bool = False) -> DataFrame:
    """One row per row: the id, ``base`` and ``all`` spans, and the text if asked for.

    ``all`` adds the disclosing terms that do not overlap a base span. Null and empty texts have
    no spans; repeated rows get equal ones; an empty table gives an empty table.
    """
    rows = docs.select(F.col(id), F.col(text))
    terms = disclosing_terms(rows, text, id)
    base = base_spans(rows.withColumn("_print", F.xxhash64(F.col(text))), text, "base")
    kept = base.select(id, *([text] if carry_text else []), "_print", "base")
    none = F.array().cast(SPANS)
    if terms.isEmpty():
        return kept.withColumn("all", F.col("base")).drop("_print")
    more = materialise(term_spans(rows, terms, id, text)).withColumnRenamed("_print", "_p")
    few = F.broadcast if more.count() <= BROADCAST_DOCS else (lambda df: df)
    joined = kept.join(few(more), F.col(id).eqNullSafe(F.col("_id")) & (F.col("_print") == F.col("_p")), "left")
    free = F.filter(
        F.coalesce(F.col("_term_spans"), none),
        lambda t: ~F.exists(F.col("base"), lambda b: (b.start < t.end) & (t.start < b.end)),
    )
    return joined.withColumn("all", F.array_sort(F.concat("base", free))).drop("_id", "_p", "_print", "_term_spans")


def rendered(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*map(F.lit, (*KINDS, "term")))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s.kind + 1), s.start, s.end)), ",")


def sanitised(text: Column, spans: Column, terms_as: str = "[TERM]") -> Column:
    """The text with every span replaced by its kind; of overlapping spans the first counts."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS), F.lit(terms_as))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        grown = F.struct(
            s.end.alias("at"),
            F.concat(acc.out, F.substring(text, acc.at + 1, s.start - acc.at), F.element_at(names, s.kind + 1)).alias("out"),
        )
        return F.when(s.start >= acc.at, grown).otherwise(acc)

    return F.aggregate(spans, begin, step, lambda acc: F.concat(acc.out, F.substring(text, acc.at + 1, F.length(text))))
