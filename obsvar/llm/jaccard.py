"""Exact set-similarity join of texts on word shingles by filters under several token orders.

Two similar sets share a token among the first few of each, under any common order of all tokens.
Three orders are used, all from rare to frequent, with ties broken by different hashes. The first
makes candidates through an inverted index, where a somewhat longer prefix must share several
tokens; the other two must agree, and what is left is verified on the whole sets. Equal sets are one node throughout.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsvar.llm.components import components
from obsvar.llm.shingles import frequency_levels, signatures, token_sets
from obsvar.llm.textblocks import small_batches
from obsvar.session import discard, written

#: Bits of the filter of ids whose sets are read again: a fixed size; full, it only saves less.
FILTER_BITS = 20
#: Shared tokens among the first of both sets, under the first order, that make a candidate.
AGREE = 3
#: Shared prefix tokens of a set that go along with its postings.
HEAD = 32


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _agreed(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that may be similar, of rows (a, b, an, bn, ap, bp, seen).

    A row stands for ``seen`` shared prefix tokens, and for the places of one of them in both sets.

    Enough tokens must be shared; and as no token before the first shared one is, what is left of
    either set after its place there must suffice.
    """
    tally = pairs.groupBy("a", "b").agg(
        F.sum("seen").alias("shared"), *(F.min(c).alias(c) for c in ("an", "bn", "ap", "bp"))
    )
    least = F.least("an", "bn")
    enough, total = F.ceil(least * percent / 100), percent * (F.col("an") + F.col("bn"))
    rest = F.least(F.col("an") - F.col("ap"), F.col("bn") - F.col("bp")) * (100 + percent)
    return tally.filter((F.col("shared") >= F.least(F.lit(AGREE), enough)) & (rest >= total)).select("a", "b")


def _slot(id: Column) -> Column:
    return F.xxhash64(F.coalesce(id, F.lit(-1))).bitwiseAND((1 << FILTER_BITS) - 1).cast("int")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose filters agree under every order and whose sets are similar enough."""
    filters = sets.select("node", "second", "third")
    for end in ("a", "b"):
        side = filters.toDF(end, f"{end}2", f"{end}3")
        pairs = pairs.join(side, end)
    pairs = pairs.filter(F.arrays_overlap("a2", "b2") & F.arrays_overlap("a3", "b3")).select("a", "b")
    whole = sets.select("node", "n", "tokens")
    for end in ("a", "b"):
        pairs = pairs.join(whole.toDF(end, f"{end}n", f"{end}t"), end)
    common = F.size(F.array_intersect("at", "bt"))
    return pairs.withColumn("common", common).filter(
        F.col("common") * 100 >= percent * (F.col("an") + F.col("bn") - F.col("common"))
    ).select("a", "b")


def _sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, reader) -> tuple[DataFrame, str]:
    """Tokens and prefixes of the given nodes, read again from one text of each; the table's path."""
    involved = classes.join(nodes, "node").select("f1", "f2", F.col("n").alias("_n"), "node", "rep")
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[[r[0] for r in involved.select(_slot(F.col("rep"))).distinct().collect()]] = True
    sets = reader(np.packbits(bits, bitorder="little"))
    again = docs.select("id", sets(_slot(F.col("id")), F.col("text")).alias("s")).filter("s is not null")
    again = again.select("id", "s.*").join(involved, ["f1", "f2"]).filter(
        (F.col("n") == F.col("_n")) & F.col("id").eqNullSafe(F.col("rep"))
    )
    once = again.dropDuplicates(["f1", "f2"])  # rows that repeat an id and its text
    return written(once.select("node", "n", "tokens", "second", "third"), "jaccard-sets")


def _compared(docs: DataFrame, classes: DataFrame, shared: DataFrame, percent: int, reader) -> DataFrame:
    """The similar pairs among those that share prefix tokens; only their sets are read."""
    pairs, pairs_at = written(_agreed(shared, percent), "jaccard-pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets, sets_at = _sets(docs, classes, nodes, reader)
    links, _ = written(_verified(pairs, sets, percent), "jaccard-links")
    discard(docs.sparkSession, pairs_at, sets_at)
    return links


def _postings(classes: DataFrame) -> tuple[DataFrame, str]:
    """(token, node, mid, at) of the prefix tokens that several nodes have; ``at`` packs size and place. The table's path.

    Most tokens stand in one prefix alone: a count by token is all that is shuffled of those. The
    others are merged whatever their number, as no broadcast of them would do for a large corpus.
    """
    held = classes.select("node", "mid", "n", F.posexplode("prefix").alias("pos", "token"))
    common = held.groupBy("token").agg(F.count("*").alias("of")).filter("of > 1").select("token")
    packed = held.select("token", "node", "mid", (F.shiftleft(F.col("n").cast("bigint"), 32) + F.col("pos")).alias("at"))
    return written(packed.join(common.hint("merge"), "token", "left_semi"), "jaccard-postings")


def _links(docs: DataFrame, classes: DataFrame, postings: DataFrame, postings_at: str, percent: int, reader) -> DataFrame:
    """Edges (a, b) between nodes that connect all nodes which a chain of similar pairs connects.

    First every posting list is compared with its most typical member alone, which is linear. What
    these links leave apart is compared in full: in lists whose members still have different
    labels, the members apart from the typical one's component meet all members of other labels.
    Pairs with one label are connected already and need no comparison.
    """
    spark = docs.sparkSession
    n, pos = F.shiftright("at", 32).cast("int").alias("n"), F.col("at").bitwiseAND((1 << 32) - 1).cast("int").alias("pos")
    postings = postings.select("token", "node", "mid", n, pos)
    lists = (
        postings.groupBy("token")
        .agg(F.max(F.struct("mid", "node", "n", "pos")).alias("hub"), F.min("node").alias("low"), F.max("node").alias("high"))
        .filter("low <> high")
        .select("token", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.pos").alias("hub_pos"))
    )
    shared, shared_at = written(postings.drop("mid").join(lists, "token"), "jaccard-lists")
    discard(spark, postings_at)
    star = shared.filter(F.col("node") != F.col("hub")).filter(_sizes_fit("n", "hub_n", percent)).select(
        F.col("node").alias("a"), F.col("hub").alias("b"), F.col("n").alias("an"), F.col("hub_n").alias("bn"),
        F.col("pos").alias("ap"), F.col("hub_pos").alias("bp"), F.lit(1).alias("seen"),
    )
    links = _compared(docs, classes, star, percent, reader)
    labels = components(links)

    nodes = shared.select("node").distinct().join(labels, "node", "left")
    named = shared.join(nodes.select("node", F.coalesce("label", "node").alias("label")), "node")
    hubs = labels.select(F.col("node").alias("hub"), F.col("label").alias("hub_label"))
    named = named.join(hubs, "hub", "left").withColumn("hub_label", F.coalesce("hub_label", "hub"))
    mixed = named.groupBy("token").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h").select("token")
    named, named_at = written(named.join(mixed, "token"), "jaccard-mixed")
    heads = shared.join(named.select("node").distinct(), "node", "left_semi").groupBy("node")
    heads = heads.agg(F.slice(F.array_sort(F.collect_list(F.struct("pos", "token"))), 1, HEAD).alias("h"))
    heads = heads.select("node", F.col("h.token").alias("head"), F.col("h.pos").alias("places"))
    named = named.join(heads, "node")
    apart = named.filter("label <> hub_label").select(
        "token", *(F.col(c).alias(f"x{c}") for c in ("node", "n", "pos", "label", "head", "places"))
    )
    # of the tokens a pair shares, the first one makes it, if the heads show which that is
    both = F.array_intersect("head", "xhead")
    full = (F.size("head") == HEAD) | (F.size("xhead") == HEAD)
    least = F.least(F.lit(AGREE), F.ceil(F.least("n", "xn") * percent / 100))
    # at most so many are common: those of the heads, and what either set has after the last of them
    last = F.element_at(both, -1)
    after = F.least(*(F.col(f"{x}n") - F.get(f"{x}places", F.array_position(f"{x}head", last).cast("int") - 1) - 1 for x in ("", "x")))
    common = F.when(F.size(both) == 0, F.least("n", "xn")).otherwise(F.size(both) + after)
    rest = (
        apart.join(named, "token")
        .filter((F.col("label") != F.col("xlabel")) & _sizes_fit("n", "xn", percent))
        .filter((F.col("label") == F.col("hub_label")) | (F.col("xnode") < F.col("node")))
        .filter((F.size(both) == 0) | ((F.get(both, F.lit(0)) == F.col("token")) & (full | (F.size(both) >= least))))
        .filter(common * (100 + percent) >= percent * (F.col("n") + F.col("xn")))
        .withColumn("seen", F.when(F.size(both) == 0, 1).when(full, AGREE).otherwise(F.size(both)))
    )
    one = F.struct(F.col("xnode").alias("v"), F.col("xn").alias("n"), F.col("xpos").alias("p"))
    two = F.struct(F.col("node").alias("v"), F.col("n").alias("n"), F.col("pos").alias("p"))
    rest = rest.select(F.least(one, two).alias("s"), F.greatest(one, two).alias("t"), "seen")  # by node: they differ
    columns = [F.col(f"{end}.{c}").alias(name) for end, side in (("s", "a"), ("t", "b")) for c, name in (("v", side), ("n", f"{side}n"), ("p", f"{side}p"))]
    others = _compared(docs, classes, rest.select(*columns, "seen"), percent, reader)
    discard(spark, shared_at, named_at)
    return links.union(others)


def similar_groups(
    docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``.

    Two texts are linked when their sets of ``words``-word shingles (ASCII lower case, words
    between ASCII white space, a shorter text as one shingle) have a Jaccard similarity of at
    least ``percent`` of a hundred. ``component_id`` is the smallest id reachable by links, the
    row's own included. Null, empty and blank texts have no set and no link. Rows that share an
    id are one document in the result's sense: what either reaches, both reach, if each is the
    smallest of its set. A null id is no id: it reaches others, and gets null if it reaches none.
    No pair within a posting list is skipped unless it is connected or proved dissimilar.
    """
    rows = small_batches(docs).select(F.col(id).alias("id"), F.col(text).alias("text"))
    levels = frequency_levels(rows, "text", words)
    signed = rows.select("id", signatures(words, percent, levels, AGREE)(F.col("text")).alias("s")).select("id", "s.*")
    signed, signed_at = written(signed, "jaccard-signatures")
    classes = (
        signed.filter("n > 0")
        .groupBy("f1", "f2", "n")
        .agg(F.min("id").alias("rep"), F.first("mid").alias("mid"), F.first("prefix").alias("prefix"))
        .withColumn("node", F.coalesce("rep", "f1"))
    )
    classes, classes_at = written(classes, "jaccard-classes")
    # prefixes are stored as long as they are needed: once signed, and until the postings are made
    signed, _ = written(signed.select("id", "n", "f1", "f2"), "jaccard-prints")
    discard(docs.sparkSession, signed_at)
    postings, postings_at = _postings(classes)
    classes, _ = written(classes.select("f1", "f2", "n", "node", "rep"), "jaccard-nodes")
    discard(docs.sparkSession, classes_at)
    links = _links(rows, classes, postings, postings_at, percent, lambda wanted: token_sets(words, percent, levels, wanted))
    names = classes.select("f1", "f2", "n", "node", "rep")
    labels = components(links)
    smallest = labels.join(names.select("node", "rep"), "node").groupBy("label").agg(F.min("rep").alias("least"))
    labels = labels.join(smallest, "label").select("node", "least")
    names = names.join(labels, "node", "left").select("f1", "f2", "n", F.coalesce("least", "rep").alias("least"))
    return signed.select("id", "n", "f1", "f2").join(names, ["f1", "f2", "n"], "left").select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id")
    )
