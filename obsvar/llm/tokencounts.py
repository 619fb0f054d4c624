"""Token counts behind a cache keyed by digests of content and of tokenizer version.

Texts of one content are encoded once, ever: their digests meet the stored counts first, and only
contents that no earlier call has counted are encoded and appended to the store.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import types
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsvar.llm import textblocks as tb
from obsvar.llm.ranges import fresh
from obsvar.session import discard, written

#: Missing digests up to this number (32 bytes each) are broadcast to the scan of the texts.
BROADCAST_DIGESTS = 500_000
#: Bytes of text encoded at once; their tokens take some 50 times as much.
AT_ONCE = 1 << 18
_CACHE = "digest binary, n_tokens bigint, tokenizer string"
_OPTIONS = "no special tokens added, no truncation, no padding"
#: Pieces whose counts a Python worker remembers, and the characters of the longest of them.
PIECES, PIECE = 1 << 19, 48
#: A place that no byte-level pre-token spans: white space after something else.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer's file, the version of its library, and how it is called."""
    if path.endswith(".json"):
        import tokenizers as library
    elif path.endswith(".model"):
        import sentencepiece as library
    else:
        raise ValueError(f"neither a .json nor a .model tokenizer: {path}")
    said = f"{library.__name__} {library.__version__} {_OPTIONS}".encode()
    return hashlib.sha256(hashlib.sha256(Path(path).read_bytes()).digest() + said).hexdigest()


def content_digest(text: str = "text") -> Column:
    """SHA-256 of the normalised content: null is the empty text.

    Nothing else is normalised, as case, white space and Unicode form all change byte-level tokens.
    """
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def _counter(path: str, version: str) -> Callable[[list[str]], list[int]]:
    """Counts of a list of texts, by the tokenizer at ``path`` on this executor.

    A Python worker keeps its last tokenizer from task to task, since each one that is loaded
    leaves some 8 MB behind. Functions that travel by value have no module of their own to keep it
    in, hence the entry in ``sys.modules``.
    """
    kept = vars(sys.modules.setdefault("obsvar_kept", types.ModuleType("obsvar_kept")))
    if kept.get("version") != version:
        kept.update(version=version, counter=_loaded(path, version))
    return kept["counter"]


def _loaded(path: str, version: str) -> Callable[[list[str]], list[int]]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    if tokenizer_digest(path) != version:
        raise RuntimeError(f"the tokenizer at {path} is another one than the driver's")
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    said = json.loads(Path(path).read_text())
    pre = said.get("pre_tokenizer") or {}
    additive = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not said.get("normalizer")

    def encoded(texts: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return _by_piece(encoded) if additive else encoded


def parts(text: str, size: int) -> Iterator[str]:
    """``text`` cut at places where no pre-token of a byte-level tokenizer goes on.

    A pre-token holds white space only in front of its other characters or alone, so none spans a
    cut, and looking ahead from before a cut never sees past it: counts of parts add up exactly.
    """
    start = 0
    while found := _CUT.search(text, start + size):
        yield text[start : found.end()]
        start = found.end()
    yield text[start:]


def _by_piece(encoded: Callable[[list[str]], list[int]]) -> Callable[[list[str]], list[int]]:
    """Counts that add up those of the smallest parts, of which each is encoded once as long as it is remembered."""
    known: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        cut = [_CUT.split(t) for t in texts]
        if len(known) > PIECES:
            known.clear()
        new = {p for pieces in cut for p in pieces if p not in known}
        if new:
            known.update(zip(new, encoded(list(new)), strict=True))
        found = [sum(map(known.__getitem__, pieces)) for pieces in cut]
        for p in new:
            if len(p) > PIECE:
                del known[p]
        return found

    def counts(texts: list[str]) -> list[int]:
        if len(texts) > 1 or len(texts[0]) <= AT_ONCE:
            return count(texts)
        return [sum(count([p])[0] for p in parts(texts[0], AT_ONCE))]

    return counts


def _encode(path: str, version: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or _counter(path, version)
            texts, found = batch.column(1).cast(pa.large_string()), []
            sizes = np.cumsum(np.asarray(pc.binary_length(texts).to_numpy(zero_copy_only=False), np.int64))
            low = 0
            while low < len(texts):
                before = sizes[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(sizes, before + AT_ONCE, "right")))
                found += count(texts[low:high].to_pylist())
                low = high
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["digest", "n_tokens"])

    return run


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) that the cache holds for a tokenizer; calls at one time may store a digest twice."""
    rows = spark.read.schema(_CACHE).parquet(cache).filter(F.col("tokenizer") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def counted(docs: DataFrame, tokenizer: str, cache: str, text: str = "text", out: str = "tokens") -> DataFrame:
    """``docs`` with a struct ``out``: n_bytes (UTF-8) and n_tokens of the text.

    ``tokenizer`` is the path of a tokenizer file that every executor can read, ``cache`` a folder
    all of them share; it is made if missing, holds one partition for each tokenizer version, and
    only grows. Misses are encoded and appended before this returns; the join with the counts is
    left to the caller's plan. Copies of one text are reduced within each partition before they
    meet, so a text that owns most rows is encoded once and sent once a partition. A null text
    counts as the empty one. An empty table gives an empty table, and stores nothing. A column
    already called ``out`` is replaced; all other columns stay, whatever their names.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    docs = docs.drop(out)
    spark.createDataFrame([], _CACHE).write.mode("append").partitionBy("tokenizer").parquet(cache)
    digest = fresh("_digest", docs)
    keyed = tb.small_batches(docs).withColumn(digest, content_digest(text))
    wanted = keyed.select(F.col(digest).alias("digest"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    stored, paths = cached(spark, cache, version), []
    if not stored.isEmpty():  # all misses: no need to ask
        missing, path = written(wanted.select("digest").distinct().join(stored, "digest", "left_anti"), "digests")
        paths.append(path)
        small = F.broadcast if missing.count() <= BROADCAST_DIGESTS else (lambda df: df)
        wanted = wanted.join(small(missing), "digest", "left_semi")
    once = wanted.groupBy("digest").agg(F.first("text").alias("text"))
    new = once.mapInArrow(_encode(tokenizer, version), "digest binary, n_tokens bigint")
    new.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)
    discard(spark, *paths)

    n_tokens = fresh("_n_tokens", keyed)
    counts = cached(spark, cache, version).select(F.col("digest").alias(digest), F.col("n_tokens").alias(n_tokens))
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint")
    n_bytes = fresh("_n_bytes", keyed)
    joined = keyed.withColumn(n_bytes, size).join(counts, digest, "left")
    both = F.struct(F.col(n_bytes).alias("n_bytes"), F.col(n_tokens).alias("n_tokens"))
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns), both.alias(out))
