"""Prefix trie of conversations, its subtree totals by the Euler-tour technique.

A node is a distinct sequence of first turns. Every node gets an enter and an exit arc, linked to
one tour of the trie; list ranking gives each arc its position, and a subtree's total is the
difference of the prefix sums at its two arcs. Texts are read once: digests stand for turns, and
XORs of (depth, digest) hashes, 128 bits, for sequences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsvar.llm.listrank import BLOCK, list_ranks
from obsvar.llm.ranges import ordered_sums
from obsvar.session import discard, written

#: Keys with more rows than both are joined by broadcast, of which fewer than ``HOT_KEYS`` exist.
HOT_ROWS, HOT_KEYS = 10_000, 1_000
#: Turns of one conversation that are summed together, and positions of the tour likewise.
STRETCH, BUCKET = 4_096, 65_536
_NOTHING = hashlib.sha256(b"").hexdigest()


def _hot_join(left: DataFrame, right: DataFrame, on: Sequence[str], rows: str) -> DataFrame:
    """Inner join with a written ``right`` of unique keys, ``rows`` counting the left rows of each.

    A key that owns a large part of ``left`` would be one task: such keys, fewer than ``HOT_KEYS``
    by their counts, are broadcast, and only the other rows are shuffled.
    """
    on = list(on)
    total = right.agg(F.sum(rows)).first()[0] or 0
    hot = F.col(rows) > max(HOT_ROWS, total // HOT_KEYS)
    if right.filter(hot).isEmpty():
        return left.join(right, on)
    few = F.broadcast(right.filter(hot))
    others = left.join(F.broadcast(right.filter(hot).select(on)), on, "left_anti")
    return left.join(few, on).unionByName(others.join(right.filter(~hot), on))


def _digest(at: int) -> Column:
    """A 64-bit part of SHA-256 over the role, with its length before it, and the text."""
    said = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return F.conv(F.substring(F.sha2(said.cast("binary"), 256), 1 + 16 * at, 16), 16, -10).cast("bigint")


def turns(
    table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The turns (conv_id, place, d1, d2, words) in global order, and (conv_id, start, n) of each conversation.

    Turns follow ``turn``, null first; ties follow the digests. A null role or text is empty. Rows
    without a conversation id belong to none and are left out. A conversation's turns are the
    ``n`` places from ``start``. Ids are whole numbers; other columns are not read.
    """
    filled = [F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((role, "role"), (text, "text"))]
    rows = table.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), *filled
    )
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    narrow = rows.select("conv_id", "turn", _digest(0).alias("d1"), _digest(1).alias("d2"), words.alias("words"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("d1"), F.col("d2")]
    placed, _ = ordered_sums(narrow, order, {}, "place")
    placed = placed.select("conv_id", "place", "d1", "d2", "words")
    return placed, placed.groupBy("conv_id").agg(F.min("place").alias("start"), F.count("*").alias("n"))


def as_they_are(table: DataFrame, **columns: str) -> DataFrame:
    """The paths of conversations for ``trie``, each as it was held."""
    placed, convs = turns(table, **columns)
    convs, _ = written(convs, "conversations")
    depth = (F.col("place") - F.col("start") + 1).cast("int")
    found = _hot_join(placed, convs, ["conv_id"], "n").withColumn("depth", depth)
    return found.select("conv_id", "depth", "d1", "d2", "words", (F.col("depth") == F.col("n")).alias("last"))


def forked(table: DataFrame, family: int = 20, most: int = 4, **columns: str) -> DataFrame:
    """Paths of conversations rebuilt as forks: the first turns of a family's first conversation, then its own.

    Conversation c takes the first h turns of c - c % ``family`` (all if fewer, none if absent) and
    goes on with its own turns after its first h, h being crc32 of its decimal id modulo ``most``.
    A conversation that is left without a turn has one row of depth 0.
    """
    placed, convs = turns(table, **columns)
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    convs = convs.withColumns({"h": F.pmod(crc, F.lit(most)).cast("int"), "base": F.expr(f"conv_id - conv_id % {family}")})
    convs, first = written(convs, "conversations")
    held = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("b"), F.col("start").alias("base_start"))
    taken = F.least("h", F.coalesce("b", F.lit(0))).cast("int")
    plan = convs.join(held, "base", "left").withColumn("m", taken)
    plan = plan.withColumn("length", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("int"))
    plan, _ = written(plan.select("conv_id", "start", "n", "h", "m", "length", "base_start"), "forks")
    discard(table.sparkSession, first)

    wanted = plan.filter("m > 0").select("conv_id", "length", "base_start", F.explode(F.expr("sequence(0, m - 1)")).alias("k"))
    wanted = wanted.select("conv_id", "length", (F.col("base_start") + F.col("k")).alias("place"), (F.col("k") + 1).alias("depth"))
    borrowed = wanted.join(placed.drop("conv_id"), "place")
    nth = F.col("place") - F.col("start") - F.col("h")
    own = _hot_join(placed, plan, ["conv_id"], "n").filter(nth >= 0)
    own = own.withColumn("depth", (F.col("m") + nth + 1).cast("int"))
    row = ["conv_id", "depth", "d1", "d2", "words", (F.col("depth") == F.col("length")).alias("last")]
    bare = plan.filter("length = 0").selectExpr("conv_id", "0 as depth", "0L as d1", "0L as d2", "0L as words", "true as last")
    return borrowed.select(row).union(own.select(row)).union(bare)


def _prefixes(paths: DataFrame) -> DataFrame:
    """``paths`` with (p1, p2) for the sequence up to the turn and (q1, q2) for the one before it.

    The running XOR restarts every ``STRETCH`` turns; the totals of a conversation's stretches are
    put together apart, so a very long conversation is not one task.
    """
    keys = ["conv_id", "_stretch"]
    rows = paths.withColumns(
        {
            "_stretch": F.expr(f"greatest(depth - 1, 0) div {STRETCH}"),
            "z1": F.when(F.col("depth") > 0, F.xxhash64("depth", "d1")).otherwise(0),
            "z2": F.when(F.col("depth") > 0, F.xxhash64(F.lit(9), "d2", "depth")).otherwise(0),
        }
    )
    inside = Window.partitionBy(*keys).orderBy("depth")
    found = rows.withColumns({p: F.bit_xor(z).over(inside) for p, z in (("p1", "z1"), ("p2", "z2"))})
    long = rows.filter(F.col("_stretch") > 0)
    if not long.isEmpty():
        totals = rows.groupBy(*keys).agg(F.bit_xor("z1").alias("t1"), F.bit_xor("z2").alias("t2"))
        earlier = Window.partitionBy("conv_id").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
        carried = totals.withColumns({c: F.bit_xor(t).over(earlier) for c, t in (("c1", "t1"), ("c2", "t2"))})
        found = found.join(carried.filter("_stretch > 0").select(*keys, "c1", "c2"), keys, "left")
        for p, c in (("p1", "c1"), ("p2", "c2")):
            found = found.withColumn(p, F.col(p).bitwiseXOR(F.coalesce(c, F.lit(0))))
    before = [F.col(p).bitwiseXOR(F.col(z)).alias(q) for p, z, q in (("p1", "z1", "q1"), ("p2", "z2", "q2"))]
    return found.select("conv_id", "depth", "words", "last", "p1", "p2", *before)


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each node, rows being sorted by node and id: one running state."""
    names = ["depth", "p1", "p2", "ends_sha256"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.string()]
    node, state = None, None
    for batch in batches:
        done: list[tuple] = []
        keys = zip(*(batch.column(c).to_pylist() for c in names[:3]), strict=True)
        for key, conv in zip(keys, batch.column("conv_id").to_pylist(), strict=True):
            if key != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(str(conv).encode())
            else:
                state.update(f",{conv}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)
    if node is not None:
        last = (*node, state.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(last, types, strict=True)], names)


def _nodes(paths: DataFrame) -> DataFrame:
    """One row per node, numbered in the order of (smallest member, depth): chains of one member are runs."""
    at = ["depth", "p1", "p2"]
    rows, path = written(_prefixes(paths), "prefixes")
    groups = rows.filter("depth > 0").groupBy(*at)
    inner = groups.agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.max("q1").alias("q1"), F.max("q2").alias("q2"),
    )
    whole = rows.filter("last").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    root = whole.filter("n_convs > 0").selectExpr(
        "0 as depth", "0L as p1", "0L as p2", "conv_id", "n_convs", "0L as words", "0L as q1", "0L as q2"
    )
    ends = rows.filter("last").select(*at, "conv_id").repartition(*at).sortWithinPartitions(*at, "conv_id")
    digests = ends.mapInArrow(_end_digests, "depth int, p1 bigint, p2 bigint, ends_sha256 string")
    found = inner.unionByName(root).join(digests, at, "left")
    found = found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NOTHING)))
    numbered, _ = ordered_sums(found, [F.col("conv_id"), F.col("depth")], {}, "node")
    stored, _ = written(numbered, "nodes")
    discard(paths.sparkSession, path)
    return stored


def _linked(nodes: DataFrame) -> DataFrame:
    """``nodes`` with their place among their parent's children.

    Of a node's children the one with its own smallest member, if any, comes first and is the next
    node by number. All others are tops of chains, sorted by smallest member under their parent:
    ``first`` is the first of them, ``n_side`` their number, and a top has ``parent`` and ``next``.
    """
    chains = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "node", "q1", "q2")).alias("top"), F.max("node").alias("tail"))
    above = [(F.col("top.depth") - 1).alias("depth"), F.col("top.q1").alias("p1"), F.col("top.q2").alias("p2")]
    tops = chains.filter("top.depth > 0").select(*above, F.col("top.node").alias("child"))
    counts = tops.groupBy("depth", "p1", "p2").agg(F.count("*").alias("n_side"), F.min("child").alias("first"))
    named = nodes.select("depth", "p1", "p2", F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    parents, path = written(counts.join(named, ["depth", "p1", "p2"]), "parents")
    sides = _hot_join(tops, parents, ["depth", "p1", "p2"], "n_side").select("parent", "parent_conv_id", "child")
    sides, _ = ordered_sums(sides, [F.col("parent"), F.col("child")], {}, "place")
    sides, sorted_path = written(sides, "sides")
    after = sides.select((F.col("place") - 1).alias("place"), F.col("parent").alias("same"), F.col("child").alias("next"))
    following = F.when(F.col("same") == F.col("parent"), F.col("next")).alias("next")
    tops = sides.join(after, "place", "left").select(F.col("child").alias("node"), "parent", "parent_conv_id", following)
    tails = chains.select(F.col("tail").alias("node"), F.lit(True).alias("is_tail"))
    firsts = parents.select(F.col("parent").alias("node"), "first", "n_side")
    found = nodes.drop("p1", "p2", "q1", "q2").join(tops, "node", "left").join(tails, "node", "left").join(firsts, "node", "left")
    goes_on = F.col("is_tail").isNull()
    children = F.coalesce("n_side", F.lit(0)) + goes_on.cast("bigint")
    found = found.withColumns({"goes_on": goes_on, "n_children": children}).drop("is_tail", "n_side")
    linked, _ = written(found, "linked")
    discard(nodes.sparkSession, path, sorted_path)
    return linked


def _arcs(linked: DataFrame) -> DataFrame:
    """The tour as a list (arc, next): 2 * node enters a node, 2 * node + 1 leaves it."""
    leave = "2 * node + 1"
    made = [
        f"struct(2 * node as arc, case when goes_on then 2 * node + 2 when first is not null then 2 * first else {leave} end as next)",
        f"if(goes_on, struct(2 * node + 3 as arc, coalesce(2 * first, {leave}) as next), null)",
        f"if(parent is not null or depth = 0, struct({leave} as arc, coalesce(2 * next, 2 * parent + 1) as next), null)",
    ]
    arcs = F.explode(F.array_compact(F.array(*(F.expr(m) for m in made))))
    return linked.select(arcs.alias("a")).select("a.arc", "a.next")


def _subtrees(linked: DataFrame, positions: DataFrame) -> DataFrame:
    """(node, n_leaves, saved_tokens): prefix sums at a node's exit less those at its entry."""
    values = linked.selectExpr("node", "n_children = 0 as leaf", "(n_convs - 1) * words as saved")
    tour = positions.selectExpr("position", "arc div 2 as node", "arc % 2 = 1 as leaves").join(values, "node")
    gain = {
        "leaf": F.when(~F.col("leaves") & F.col("leaf"), 1).otherwise(0).cast("bigint"),
        "saved": F.when(F.col("leaves"), 0).otherwise(F.col("saved")).cast("bigint"),
    }
    tour = tour.withColumns({"_bucket": F.expr(f"position div {BUCKET}L"), **gain})
    inside = Window.partitionBy("_bucket").orderBy("position")
    totals = tour.groupBy("_bucket").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    over = Window.orderBy("_bucket")  # one row for 65,536 arcs
    carried = totals.select("_bucket", *((F.sum(c).over(over) - F.col(c)).alias(f"_{c}") for c in ("leaf", "saved")))
    before = {c: F.sum(c).over(inside) - F.col(c) for c in ("leaf", "saved")}
    sums = tour.withColumns(before).join(carried, "_bucket")
    sign = F.when(F.col("leaves"), 1).otherwise(-1)
    return sums.groupBy("node").agg(
        *(F.sum(sign * (F.col(c) + F.col(f"_{c}"))).cast("bigint").alias(out) for c, out in (("leaf", "n_leaves"), ("saved", "saved_tokens")))
    )


def trie(paths: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per distinct sequence of first turns, the empty one (the root) included.

    ``paths`` has a row (conv_id, depth from 1, d1, d2, words, last) per turn, as ``as_they_are``
    and ``forked`` make it. Columns: conv_id (smallest member) and depth, together the node's key;
    parent_conv_id (root: null), n_convs (members), n_children, n_leaves (childless nodes of its
    subtree), saved_tokens (over its subtree, words of a node's last turn for each member but one),
    ends_sha256 (of the ids of members that end here, ascending, joined by commas). Without a
    conversation there is no node. Tables that the result is read from stay in the shared folder.

    The digest of a node's ids is sequential by its nature: it is one running state over sorted
    rows, never a list in memory.
    """
    linked = _linked(_nodes(paths))
    sums = _subtrees(linked, list_ranks(_arcs(linked), block))
    parent = F.when(F.col("depth") == 0, None).otherwise(F.coalesce("parent_conv_id", "conv_id"))
    return linked.join(sums, "node").select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), parent.alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )
