"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A mask names the token positions of a window that count; the others may differ. Hashes of the
masked windows of benchmark items meet those of the documents in one join. Each hit fixes how item
and document lie side by side, and the words around it are compared one by one, so that an overlap
with substituted words is found and a chance hit is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsvar.llm.ranges import fresh
from obsvar.session import materialise

#: Offsets of the tokens that count.
MASKS = ((0, 1, 2, 4), (0, 1, 3, 5), (0, 2, 3, 6))
SPAN = 1 + max(map(max, MASKS))
#: Side-by-side words looked at, and how many of a hundred must agree.
WINDOW, PERCENT = 13, 80
#: Seeds are broadcast up to this number (28 bytes each, 60 MB); more are joined by a shuffle.
BROADCAST_SEEDS = 2_000_000
#: Texts with hits are named to the second read by broadcast up to this number (16 bytes each).
BROADCAST_TEXTS = 1_000_000
SEPARATOR = r"[^\p{L}\p{N}]+"


def tokens(text: str) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SEPARATOR), "")


def seeds(df: DataFrame, words: str, position: str) -> DataFrame:
    """One row for each window and mask: ``_mask``, ``_seed`` and the window's 0-based ``position``.

    The other columns go along, but not the words: they would be copied for every window.
    """
    others = [c for c in df.columns if c != words]
    shifted = [F.col(words), *(F.slice(F.col(words), k + 1, F.size(words)) for k in range(1, SPAN))]
    names = [f"w{k}" for k in range(SPAN)]
    zipped = F.arrays_zip(*(c.alias(n) for c, n in zip(shifted, names, strict=True)))
    rows = df.select(*others, F.posexplode(zipped).alias(position, "_w"))
    hashed = F.array(
        *(
            F.when(
                F.col("_w")[names[mask[-1]]].isNotNull(),
                F.xxhash64(F.lit(m), *(F.col("_w")[names[k]] for k in mask)),
            )
            for m, mask in enumerate(MASKS)
        )
    )
    return rows.select(*others, position, F.posexplode(hashed).alias("_mask", "_seed")).filter(
        F.col("_seed").isNotNull()
    )


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(id, item, shift, n_same, n_aligned): verified overlaps of documents and benchmark items.

    ``shift`` is the document's token at which the item would begin. Among every ``WINDOW`` words
    side by side (all of a shorter overlap, down to the item's own length or the window) at least
    ``PERCENT`` of a hundred agree somewhere. Items of fewer than five tokens have no seed and match
    nothing; null and empty texts match nothing. Equal items are looked up once, under the
    smallest id (null before others); rows that repeat an id have their overlaps together.
    """
    bench = (
        items.select(F.col(item_id).alias("_item"), tokens(item_text).alias("_iw"))
        .groupBy("_iw")
        .agg(F.min("_item").alias("_item"))
        .withColumn("_key", F.xxhash64("_iw"))
        .filter(F.size("_iw") > min(mask[-1] for mask in MASKS))  # with fewer words there is no seed
    )
    places = seeds(bench.select("_key", "_iw"), "_iw", "_ip")
    index = places.groupBy(F.col("_mask").alias("_m"), F.col("_seed").alias("_s")).agg(
        F.collect_list(F.struct("_key", "_ip")).alias("_at")
    )
    # an item of n words has n - 4 seeds or more, so this bounds the words of all items as well
    small = F.broadcast if places.count() <= BROADCAST_SEEDS else (lambda df: df)
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"), F.xxhash64(F.col(text)).alias("_print"))
    words = rows.select("_id", "_print", tokens("_text").alias("_dw"))
    found = seeds(words, "_dw", "_dp").join(
        small(index), (F.col("_mask") == F.col("_m")) & (F.col("_seed") == F.col("_s"))
    )
    found = found.select("_id", "_print", "_dp", F.explode("_at").alias("_hit"))
    once = found.groupBy("_id", "_print", F.col("_hit._key").alias("_key"), (F.col("_dp") - F.col("_hit._ip")).alias("_shift")).count()
    # the words of an item go to a text once, whatever the number of ways in which they may lie
    once = once.groupBy("_id", "_print", "_key").agg(F.collect_list("_shift").alias("_shifts"))
    lines = once.join(small(bench), "_key").groupBy("_id", "_print")
    lines = materialise(lines.agg(F.collect_list(F.struct("_item", "_iw", "_shifts")).alias("_lines")))
    few = F.broadcast if lines.count() <= BROADCAST_TEXTS else (lambda df: df)

    def alike(left: str, right: str) -> Column:
        return F.col(f"{left}._id").eqNullSafe(F.col(f"{right}._id")) & (F.col(f"{left}._print") == F.col(f"{right}._print"))

    hit = rows.alias("r").join(few(lines.select("_id", "_print")).alias("h"), alike("r", "h"), "left_semi")
    hit = hit.select("_id", "_print", tokens("_text").alias("_dw")).alias("t").join(lines.alias("l"), alike("t", "l"))

    def beside(item: Column, words: Column, shift: Column) -> Column:
        low = F.greatest(F.lit(0), -shift)
        span = F.least(F.size(words), F.size("_dw") - shift) - low
        same = F.zip_with(F.slice(words, low + 1, span), F.slice("_dw", low + shift + 1, span), lambda a, b: (a == b).cast("int"))
        return F.struct(item.alias("_item"), shift.alias("_shift"), F.size(words).alias("_len"), same.alias("_same"))

    every = F.flatten(F.transform("_lines", lambda l: F.transform(l["_shifts"], lambda s: beside(l["_item"], l["_iw"], s))))
    once = hit.select(F.col("t._id").alias("_id"), F.inline(every))
    width = F.least(F.col("_len"), F.lit(WINDOW))
    best = F.array_max(
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("_same") - width, F.lit(0))),
            lambda k: F.aggregate(F.slice("_same", k + 1, width), F.lit(0), lambda a, b: a + b),
        )
    )
    verified = once.filter(best * 100 >= width * PERCENT)
    total = F.aggregate("_same", F.lit(0), lambda a, b: a + b)
    found = verified.select("_id", "_item", "_shift", total.alias("n_same"), F.size("_same").alias("n_aligned"))
    best = found.groupBy("_id", "_item", "_shift").agg(F.max(F.struct("n_same", "n_aligned")).alias("b"))
    return best.select(F.col("_id").alias(id), F.col("_item").alias("item"), F.col("_shift").alias("shift"), "b.n_same", "b.n_aligned")


def contamination(docs: DataFrame, items: DataFrame, id: str = "doc_id", **columns) -> DataFrame:
    """Per contaminated id: ``n_items``, ``n_overlaps``, ``best_item`` and its ``best_same`` words.

    The best item agrees in the most words; ties go to the smallest item.
    """
    found = overlaps(docs, items, id=id, **columns)
    best = F.min(F.struct(-F.col("n_same"), F.col("item")))
    return found.groupBy(id).agg(
        F.countDistinct("item").alias("n_items"),
        F.count("*").alias("n_overlaps"),
        best["item"].alias("best_item"),
        (-best["col1"]).cast("bigint").alias("best_same"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", **columns) -> DataFrame:
    """``docs`` without the rows whose id has a verified overlap; all columns pass through."""
    key = fresh("_leak", docs)
    leaks = contamination(docs, items, id=id, **columns).select(F.col(id).alias(key))
    return docs.join(leaks, F.col(id).eqNullSafe(F.col(key)), "left_anti")
