"""Language-model scores of all texts from a bigram trie that lies in shards.

Contexts are dealt to shards by hash. A block of texts sends each shard the successors of the
contexts that lie there; the shard counts what training texts sent, builds its part of the trie,
and answers for every text of the block at once. No task and no driver ever holds the whole model.
Contexts with a large share of all tokens are split by a class of the successor:
p(w | v) = p(class | v) p(w | v, class).

Smoothing is absolute discounting with backoff: (c(vw) - D) / c(v) for a seen bigram, else
D N(v) / c(v) times the discounted share of w among all tokens, with one share for all unknown
words. The sum over all words does not exceed one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsvar.llm import textblocks as tb
from obsvar.llm.eliasfano import Trie, joined
from obsvar.session import scratch_path

#: Bytes of text for each shard, and shards at least.
SHARD_BYTES, LEAST_SHARDS = 20 << 20, 8
#: Texts per shard that are looked at to name the contexts to be split; only the deal depends on it.
SAMPLED = 64
BLOCK_BYTES = 4 << 20
#: Marks before the first and after the last word of a text.
BEGIN, END = np.uint64(0xB5297A4D3F84D5B5), np.uint64(0x68E31DA4A1F1D3C7)
_SUB = np.uint64(0x8CB92BA72F3D8DD7)
DATA = "target int, block bigint, kind int, data binary"
TEXTS, SUMS, WORDS, ASKED, COUNTS = range(5)  # kinds of rows


def packed(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), len(a)))], np.int64)
    return head.tobytes() + b"".join(a.tobytes() for a in arrays)


def unpacked(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head, at, out = np.frombuffer(data, np.int64, 1 + 2 * n)[1:], 8 * (1 + 2 * n), []
    for code, length in zip(head[::2].tolist(), head[1::2].tolist(), strict=True):
        out.append(np.frombuffer(data, np.dtype(chr(code)), length, at))
        at += out[-1].nbytes
    return out


def _batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["target", "block", "kind", "data"])


def bigrams(block: tb.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, successor and row of every step of the texts, from ``BEGIN`` to ``END``."""
    block.words(tb.SPACE)
    word = block.hashes(block.start, block.end, lower=True)
    n = len(word) + block.rows
    first = block.edge[:-1] + np.arange(block.rows)
    last = block.edge[1:] + np.arange(block.rows)
    row = np.repeat(np.arange(block.rows), block.counts + 1)
    context, following = np.empty(n, np.uint64), np.empty(n, np.uint64)
    inner = np.ones(n, bool)
    inner[first] = False
    context[first], context[inner] = BEGIN, word
    inner = np.ones(n, bool)
    inner[last] = False
    following[last], following[inner] = END, word
    return context, following, row


@dataclass
class Plan:
    """How contexts are dealt, and what is known of the split ones."""

    shards: int
    classes: int
    hot: np.ndarray  # sorted contexts
    counts: np.ndarray = None  # their training counts
    share: np.ndarray = None  # of the classes among training tokens
    tokens: int = 0
    texts: int = 0

    def klass(self, word: np.ndarray) -> np.ndarray:
        return ((word >> np.uint64(7)) % np.uint64(self.classes)).astype(np.int64)

    def hot_place(self, context: np.ndarray) -> np.ndarray:
        """Number among the split contexts, or -1."""
        at = np.minimum(np.searchsorted(self.hot, context), len(self.hot) - 1)
        return np.where(self.hot[at] == context, at, -1)

    def sub(self, context: np.ndarray, klass: np.ndarray) -> np.ndarray:
        return tb.mix(context ^ (_SUB * (klass + 1).astype(np.uint64)))

    def shard(self, context: np.ndarray) -> np.ndarray:
        return (tb.mix(context) % np.uint64(self.shards)).astype(np.int64)

    def split(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted split contexts, with the number of the whole one and the class of each."""
        whole = np.repeat(np.arange(len(self.hot)), self.classes)
        klass = np.tile(np.arange(self.classes), len(self.hot))
        name = self.sub(self.hot[whole], klass)
        order = np.argsort(name)
        return name[order], whole[order], klass[order]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[tb.Block, np.ndarray]]:
    trains = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
    for block in tb.blocks(batch.column(0), BLOCK_BYTES):
        yield block, trains[block.first : block.first + block.rows]


def planned(rows: DataFrame) -> Plan:
    """Sizes, split contexts and their exact counts, from two reads of ``rows`` (text, train, id)."""
    size, n = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    shards = max(LEAST_SHARDS, -(-(size or 0) // SHARD_BYTES))
    part = min(1.0, SAMPLED * shards / max(1, n))
    threshold = 1 / (4 * shards)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, _ in _blocks(batch):
                context, count = np.unique(bigrams(block)[0], return_counts=True)
                often = count >= max(2, threshold * count.sum() / 2)
                total = np.array([-1, int(count.sum())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(context[often].view(np.int64), total[0])), pa.array(np.append(count[often], total[1]))], ["v", "n"]
                )

    chosen = F.xxhash64("id", "text").bitwiseAND((1 << 30) - 1) < part * (1 << 30)
    seen = rows.filter(chosen).select("text", "train").mapInArrow(look, "v bigint, n bigint").groupBy("v").agg(F.sum("n").alias("n"))
    total = max(1, seen.filter("v = -1").agg(F.sum("n")).first()[0] or 1)
    found = {r.v: r.n for r in seen.filter(F.col("n") >= threshold * total).collect() if r.v != -1}  # 1 / threshold at most
    hot = np.unique(np.append(np.array(list(found), np.int64).view(np.uint64), BEGIN))
    most = max(found.values(), default=0) / total
    plan = Plan(shards, max(1, int(np.ceil(2 * shards * most))), hot)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hots, classes, texts = np.zeros(len(hot), np.int64), np.zeros(plan.classes, np.int64), 0
        for batch in batches:
            for block, train in _blocks(batch):
                context, following, row = bigrams(block)
                keep = train[row]
                at = plan.hot_place(context[keep])
                hots += np.bincount(at[at >= 0], minlength=len(hot))
                classes += np.bincount(plan.klass(following[keep]), minlength=plan.classes)
                texts += int(train.sum())
        values = np.concatenate((hots, classes, [texts]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["k", "n"])

    sums = rows.select("text", "train").mapInArrow(count, "k bigint, n bigint").groupBy("k").agg(F.sum("n")).collect()
    values = np.zeros(len(hot) + plan.classes + 1, np.int64)
    for k, amount in sums:
        values[k] = amount
    plan.counts, classes, plan.texts = values[: len(hot)], values[len(hot) : -1], int(values[-1])
    plan.tokens = int(classes.sum())
    plan.share = np.maximum(classes, 1) / max(1, plan.tokens)
    return plan


def dealt(plan: Plan):
    """Rows for the shards from (text, train, id, number) batches: steps of the texts by context."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = 0
        for batch in batches:
            ids = batch.column(2)
            for block, train in _blocks(batch):
                number = (batch.column(3)[0].as_py() << 24) + serial
                serial += 1
                context, following, row = bigrams(block)
                hot = plan.hot_place(context) >= 0
                context[hot] = plan.sub(context[hot], plan.klass(following[hot]))
                target = plan.shard(context)
                order = np.argsort(context)
                order = order[np.argsort(target[order].astype(np.uint16 if plan.shards < 65_536 else np.int64), kind="stable")]
                context, following, row, target = context[order], following[order], row[order], target[order]
                ends = np.searchsorted(target, np.arange(plan.shards + 1))
                out = []
                own = ids.slice(block.first, block.rows)
                known = np.array(own.is_valid().to_numpy(zero_copy_only=False))
                head = packed(own.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), known, train, block.counts.astype(np.int64))
                out.append((number % plan.shards, number, TEXTS, head))
                small = np.uint16 if block.rows < 65_536 else np.uint32
                for s in range(plan.shards):
                    part = slice(ends[s], ends[s + 1])
                    if ends[s] == ends[s + 1]:
                        continue
                    names, sizes = np.unique(context[part], return_counts=True)
                    learns = train[row[part]]
                    words = following[part]
                    out.append(
                        (s, number, ASKED, packed(
                            names, sizes.astype(np.uint32), row[part].astype(small), np.packbits(learns),
                            (words[learns] >> np.uint64(32)).astype(np.uint32), words[~learns],
                        ))
                    )
                yield _batch(out)

    return deal


def _discount(counts: np.ndarray) -> float:
    once, twice = float((counts == 1).sum()), float((counts == 2).sum())
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5


def answered(plan: Plan):
    """What a shard says to each block: sums of its texts, and the words to be asked elsewhere."""
    names, whole, klass = plan.split()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, contexts, sizes, rows, learns, words = [], [], [], [], [], []
        shard = None
        for batch in batches:
            for target, block, kind, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = target
                if kind == TEXTS:
                    yield _batch([(0, block, TEXTS, data)])
                    continue
                name, size, row, flags, trained, held = unpacked(data)
                learn = np.unpackbits(flags, count=len(row)).astype(bool)
                word = np.empty(len(row), np.uint64)
                word[learn], word[~learn] = trained.astype(np.uint64) << np.uint64(32), held
                # copies: a view would keep all of the row's bytes
                for into, value in zip((contexts, sizes, rows), (name, size, row), strict=True):
                    into.append(value.copy())
                blocks.append(block)
                learns.append(learn)
                words.append(word)
        if shard is None:
            return
        length = np.array([len(r) for r in rows])
        known, place = np.unique(joined(contexts, np.uint64), return_inverse=True)
        owner = np.repeat(place.astype(np.uint32), joined(sizes, np.int64))
        del contexts, place, sizes
        learn, word = joined(learns, bool), joined(words, np.uint64)
        del learns, words
        key = (owner.astype(np.uint64) << np.uint64(32)) | (word >> np.uint64(32))
        pairs, pair_count = np.unique(key[learn], return_counts=True)
        own = np.bincount(owner[learn], minlength=len(known))
        at = np.minimum(np.searchsorted(names, known), len(names) - 1)
        is_hot = names[at] == known
        total = np.where(is_hot, plan.counts[whole[at]], own)
        trained = own > 0
        discount = _discount(pair_count)
        number = np.cumsum(trained) - 1
        mother = (pairs >> np.uint64(32)).astype(np.int64)
        followers = np.bincount(mother, minlength=len(known))
        with np.errstate(divide="ignore", invalid="ignore"):
            backoff = np.log10(discount * followers / total) - np.where(is_hot, np.log10(plan.share[klass[at]]), 0.0)
        trie = Trie(
            known[trained], backoff[trained], number[mother],
            pairs & np.uint64(0xFFFFFFFF), np.log10((pair_count - discount) / total[mother]),
        )
        asked, back = np.unique(key, return_inverse=True)
        back = back.astype(np.uint32)
        del key, pairs, pair_count, mother, number
        context = (asked >> np.uint64(32)).astype(np.int64)
        score, seen, _ = trie.look_up(known[context], asked & np.uint64(0xFFFFFFFF))
        is_begin = is_hot & (plan.hot[whole[at]] == BEGIN)
        base = np.where(is_begin, 0.0, np.log10(total + 0.5))
        counted = (total > 0) & ~is_begin
        ends = np.concatenate(([0], np.cumsum(length)))
        for k, block in enumerate(blocks):
            part = slice(ends[k], ends[k + 1])
            row, mine, pair = rows[k].astype(np.int64), owner[part], back[part]
            used, row = np.unique(row, return_inverse=True)
            n = len(used)
            sums = packed(
                used.astype(np.uint32 if used[-1] > 65_535 else np.uint16), np.bincount(row, base[mine], n),
                np.bincount(row, score[pair], n).astype(np.float32), np.bincount(row, counted[mine], n).astype(np.uint16 if n else np.uint32)
                if np.bincount(row).max() < 65_536 else np.bincount(row, counted[mine], n).astype(np.uint32),
            )
            out = [(0, block, SUMS, sums)]
            unseen = ~seen[pair]
            if unseen.any():
                far, doc, hot = word[part][unseen], used[row[unseen]], is_hot[mine[unseen]]
                target = plan.shard(far)
                order = np.argsort(target, kind="stable")
                cut = np.searchsorted(target[order], np.arange(plan.shards + 1))
                for s in np.unique(target):
                    o = order[cut[s] : cut[s + 1]]
                    out.append((int(s), block, ASKED, packed(far[o], doc[o].astype(np.uint32 if used[-1] > 65_535 else np.uint16), np.packbits(hot[o]))))
            yield _batch(out)
        plain = trained & ~is_hot
        counts = own[plain]
        yield _batch([
            (shard, 0, WORDS, packed(known[plain], counts.astype(np.uint32))),
            (0, 0, COUNTS, packed(np.array([plain.sum(), (counts == 1).sum(), (counts == 2).sum(), trie.nbytes()], np.int64))),
        ])

    return answer


def told(plan: Plan, types: int, discount: float):
    """Sums of the discounted word shares that other shards asked for."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, words, counts = [], [], []
        for batch in batches:
            for _, block, kind, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == WORDS:
                    name, n = unpacked(data)
                    words.append(name)
                    counts.append(n)
                else:
                    asked.append((block, unpacked(data)))
        name, count = joined(words, np.uint64), joined(counts, np.int64).astype(np.int64)
        real = plan.hot != BEGIN
        name = np.concatenate((name, plan.hot[real], [END]))
        count = np.concatenate((count, plan.counts[real], [plan.texts]))
        order = np.argsort(name)
        name, count = name[order], count[order]
        unknown = discount * types / max(1, plan.tokens)
        for block, (word, row, flags) in asked:
            hot = np.unpackbits(flags, count=len(word)).astype(bool)
            at = np.minimum(np.searchsorted(name, word), len(name) - 1)
            n = np.where(name[at] == word, count[at], 0)
            share = np.where(n > 0, (n - discount) / max(1, plan.tokens), np.where(hot, unknown / plan.classes, unknown))
            used, place = np.unique(row, return_inverse=True)
            value = np.log10(share) if plan.tokens else np.zeros(len(share))
            empty = np.zeros(len(used))
            yield _batch([(0, block, SUMS, packed(used, empty, np.bincount(place, value, len(used)).astype(np.float32), empty.astype(np.uint16)))])

    return tell


RESULT = "id bigint, train boolean, n_tokens bigint, n_known bigint, base double, score double"


def gathered(plan: Plan, types: int):
    """One row for each text, from the sums of its block."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: dict[int, list[np.ndarray]] = {}
        parts: dict[int, list[list[np.ndarray]]] = {}
        for batch in batches:
            for _, block, kind, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == TEXTS:
                    heads[block] = unpacked(data)
                else:
                    parts.setdefault(block, []).append(unpacked(data))
        norm = np.log10(plan.tokens + 0.5 * (types + 1))
        for block, (ids, valid, train, words) in heads.items():
            base, score, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
            for row, b, s, k in parts.get(block, []):
                base[row] += b
                score[row] += s
                known[row] += k
            tokens = words + 1
            base += np.log10(plan.texts + 0.5) - tokens * norm
            known += plan.texts > 0
            columns = [pa.array(ids, mask=~valid), pa.array(train), *map(pa.array, (tokens, known, base, score))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "train", "n_tokens", "n_known", "base", "score"])

    return gather


def scored(docs: DataFrame, train: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: id, train, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows for which ``train`` is true (null: not) and scores all. Tokens are the
    words of the text, A-Z in lower case, and one end; a null text is the empty one. ``base_score`` is the sum of
    log10((c + 0.5) / (N + 0.5 (V + 1))) of the tokens, ``score`` the log10 probability of the text under the trie.
    Repeated rows are counted and scored as often as they are there; a null id stays null. An
    empty table gives an empty table; without training rows every score is 0.
    """
    spark = docs.sparkSession
    rows = tb.small_batches(docs).select(
        F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"), F.col(id).cast("bigint").alias("id")
    )
    plan = planned(rows)
    sent = rows.withColumn("number", F.spark_partition_id().cast("bigint")).mapInArrow(dealt(plan), DATA)
    path = scratch_path(spark, "lm-sums")
    sent.repartitionById(plan.shards, F.col("target")).mapInArrow(answered(plan), DATA).write.parquet(path)
    said = spark.read.parquet(path)
    counts = [unpacked(r.data) for r in said.filter(F.col("kind") == COUNTS).select("data").collect()]  # four numbers a shard
    plain, once, twice, _ = (sum(int(c[0][k]) for c in counts) for k in range(4))
    hot = plan.counts[plan.hot != BEGIN]
    types = plain + int((hot > 0).sum()) + (plan.texts > 0)
    discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5
    asked = said.filter(F.col("kind").isin(ASKED, WORDS)).repartitionById(plan.shards, F.col("target"))
    more = asked.mapInArrow(told(plan, types, discount), DATA)
    sums = said.filter(F.col("kind").isin(TEXTS, SUMS)).union(more)
    found = sums.repartition(F.col("block")).mapInArrow(gathered(plan, types), RESULT)
    return found.select(
        F.col("id").alias(id), "train", "n_tokens", "n_known", F.lit(plan.tokens).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )
