"""Toxicity by nearest labelled examples: exact TF-IDF cosine, block-max index, weighted votes.

The classifier is fitted on a bounded sample of labelled rows. Its terms are the words and word
beginnings whose presence goes with the label; how common a term is counts over all documents.
The examples lie in blocks, and every term keeps the largest weight that it has in each block. A
query visits blocks from the highest possible score downwards and stops when no block left can hold
a nearer example, so the neighbours are exact. Votes weighted by distance are calibrated on the
examples themselves, each judged by the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from obsvar.llm import textblocks as tb
from obsvar.llm.ranges import fresh

#: Labelled rows used at most of each class: those with the smallest hashes of their ids.
EXAMPLES = 4_000
#: Terms at most, the least count of a term, and the least chi-square of term and label.
TERMS, LEAST_COUNT, LEAST_CHI = 1_024, 5, 30.0
BEGINNING = 5  # bytes of a word's beginning, itself a term of longer words
BLOCK, NEIGHBOURS, EVIDENCE = 64, 15, 3
_BEGIN = np.uint64(0x94D049BB133111EB)


def features(block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-cased words and of the beginnings of longer ones, and their rows."""
    block.words(tb.PUNCT)
    word = block.hashes(block.start, block.end, lower=True)
    longer = block.end - block.start > BEGINNING
    begin = block.hashes(block.start[longer], block.start[longer] + BEGINNING, lower=True)
    return np.concatenate((word, tb.mix(begin ^ _BEGIN))), np.concatenate((block.row, block.row[longer]))


def term_counts(block: tb.Block, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term number and count of the known terms (sorted hashes) in each row."""
    hashes, row = features(block)
    at = np.searchsorted(terms, hashes)
    at[at == len(terms)] = 0
    known = terms[at] == hashes if len(terms) else np.zeros(len(at), bool)
    cell, count = np.unique(row[known] * len(terms) + at[known], return_counts=True)
    return cell // max(1, len(terms)), cell % max(1, len(terms)), count


def vectors(block: tb.Block, terms: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of unit length; a row without known terms is zero."""
    out = np.zeros((block.rows, len(terms)), np.float32)
    row, term, count = term_counts(block, terms)
    out[row, term] = (1 + np.log(count)) * idf[term]
    return out / np.maximum(1e-9, np.linalg.norm(out, axis=1, keepdims=True))


class BlockMaxIndex:
    """Postings of example vectors in blocks, with the largest weight of each term in each block."""

    def __init__(self, examples: np.ndarray):
        self.n = len(examples)
        self.blocks, tops = [], []
        for start in range(0, self.n, BLOCK):
            part = examples[start : start + BLOCK]
            used = np.flatnonzero(part.any(axis=0))
            self.blocks.append((start, used, np.ascontiguousarray(part[:, used].T)))
            tops.append(part.max(axis=0))
        self.tops = np.array(tops, np.float32).T if tops else np.zeros((examples.shape[1], 0), np.float32)

    def nearest(self, queries: np.ndarray, k: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the ``k`` nearest examples of each query; -1 where there are fewer.

        Cosines count to five digits; ties go to the smaller number. ``skip`` names one example for
        each query that is left out.
        """
        none = np.int64(1) << 40
        best = np.full((len(queries), k), none)  # -cosine and number in one key: smaller is nearer
        bound = queries @ self.tops
        turn = np.argsort(-bound, axis=1, kind="stable")
        for rank in range(len(self.blocks)):
            reach = bound[np.arange(len(queries)), turn[:, rank]]
            worst = best[:, -1]
            floor = np.where(worst == none, 0.0, -(worst >> 21) / 1e5)
            open_rows = np.flatnonzero((reach > 0) & (reach >= floor - 2e-5))
            if not len(open_rows):
                break
            for b in np.unique(turn[open_rows, rank]):
                rows = open_rows[turn[open_rows, rank] == b]
                start, used, weights = self.blocks[b]
                score = np.rint(queries[np.ix_(rows, used)] @ weights * 1e5).astype(np.int64)
                number = start + np.arange(weights.shape[1])
                key = (-score << 21) | number
                key[score <= 0] = none
                if skip is not None:
                    key[number[None, :] == skip[rows][:, None]] = none
                both = np.concatenate((best[rows], key), axis=1)
                best[rows] = np.sort(np.partition(both, k - 1, axis=1)[:, :k], axis=1)
        found = best != none
        return np.where(found, best & ((1 << 21) - 1), -1), np.where(found, -(best >> 21) / 1e5, 0.0)


def votes(index: BlockMaxIndex, toxic: np.ndarray, weight: np.ndarray, queries: np.ndarray, skip=None):
    """Distance-weighted share of toxic neighbours, mean cosine, neighbour numbers."""
    number, cosine = index.nearest(queries, NEIGHBOURS, skip)
    pull = np.where(number >= 0, weight[number] / (1.05 - cosine), 0.0)
    share = ((pull * toxic[number]).sum(axis=1) + 0.02) / (pull.sum(axis=1) + 0.04)
    return share, cosine.sum(axis=1) / np.maximum(1, (number >= 0).sum(axis=1)), number


def _inputs(share: np.ndarray, cosine: np.ndarray) -> np.ndarray:
    odds = np.log(share / (1 - share))
    return np.stack((np.ones(len(share)), odds, odds * cosine), axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(curve, slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass
class Model:
    terms: np.ndarray  # sorted hashes
    idf: np.ndarray
    index: BlockMaxIndex
    toxic: np.ndarray  # of the examples, in index order
    weight: np.ndarray
    ids: np.ndarray
    beta: np.ndarray
    silent: float  # score of a text without known terms

    def score(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and, for each query, the nearest examples' ids with their cosines falling."""
        out = np.full(len(queries), self.silent)
        evidence = np.full((len(queries), EVIDENCE), -1, np.int64)
        rows = np.flatnonzero(queries.any(axis=1)) if self.index.n else []
        if len(rows):
            share, cosine, number = votes(self.index, self.toxic, self.weight, queries[rows])
            value = 1 / (1 + np.exp(-np.clip(_inputs(share, cosine) @ self.beta, -30, 30)))
            out[rows] = np.where(number[:, 0] >= 0, value, self.silent)
            evidence[rows] = np.where(number >= 0, self.ids[number], -1)[:, :EVIDENCE]
        return out, evidence


_COUNTS = T.ArrayType(T.StructType([T.StructField("term", T.LongType()), T.StructField("n", T.LongType())]))


@arrow_udf(T.ArrayType(T.LongType()))
def _presence(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Distinct feature hashes of each text."""
    for texts in batches:
        values, lengths = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for block in tb.blocks(texts):
            hashes, row = features(block)
            order = np.lexsort((hashes, row))
            hashes, row = hashes[order], row[order]
            new = np.ones(len(row), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
            values.append(hashes[new])
            lengths.append(np.bincount(row[new], minlength=block.rows))
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(lengths)))).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values).view(np.int64)))


def _document_counts(docs: DataFrame, text: str, terms: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of documents and, over all of them, the number that have each term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            for block in tb.blocks(batch.column(0)):
                seen += np.bincount(term_counts(block, terms)[1], minlength=len(terms))
                rows += block.rows
        numbers = np.append(np.flatnonzero(seen), len(terms))
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(np.append(seen, rows)[numbers])], ["term", "n"])

    found = tb.small_batches(docs).select(text).mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect()
    out = np.zeros(len(terms) + 1, np.int64)
    for number, n in found:
        out[number] = n
    return int(out[-1]), out[:-1]


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The model of ``labels`` (id, 0/1 label) over the texts in ``docs``.

    At most ``EXAMPLES`` labelled ids of each class are used. Labels other than 0 and 1 and null
    ids are left out; an id labelled more than once counts as toxic if it ever is; of equal texts
    one is used. Without labelled texts every score is 0.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull())
    usable = usable.groupBy(F.col(id).alias("_id")).agg(F.max(label).alias("_toxic"))
    totals = {r[0]: r[1] for r in usable.groupBy("_toxic").agg(F.count("*")).collect()}
    chosen = [usable.filter(F.col("_toxic") == y).orderBy(F.xxhash64("_id"), "_id").limit(EXAMPLES) for y in (0, 1)]
    sample = F.broadcast(chosen[0].union(chosen[1]))  # 2 x EXAMPLES rows at most
    texts = docs.select(F.col(id).alias("_doc"), F.col(text).alias("_text")).join(sample, F.col("_doc") == F.col("_id"))
    texts = texts.groupBy(F.xxhash64("_text").alias("_print")).agg(
        F.min_by(F.struct("_id", "_text", "_toxic"), F.struct("_id", "_text")).alias("e")
    ).select("e._id", "e._text", "e._toxic")
    counts = texts.select("_toxic", F.explode(_presence("_text")).alias("term"))
    size = {r[0]: r[1] for r in texts.groupBy("_toxic").agg(F.count("*")).collect()}
    n1, n0 = float(size.get(1, 0)), float(size.get(0, 0))
    a, b = F.sum("_toxic").cast("double"), F.sum(1 - F.col("_toxic")).cast("double")
    tally = counts.groupBy("term").agg(a.alias("a"), b.alias("b")).filter(F.col("a") + F.col("b") >= LEAST_COUNT)
    n, cross = n1 + n0, F.col("a") * (n0 - F.col("b")) - F.col("b") * (n1 - F.col("a"))
    spread = (F.col("a") + F.col("b")) * (n - F.col("a") - F.col("b")) * n1 * n0
    chi = F.when(spread > 0, cross * cross * n / spread).otherwise(0.0)
    top = tally.withColumn("chi", chi).filter(F.col("chi") >= LEAST_CHI).orderBy(F.desc("chi"), "term").limit(TERMS)
    terms = np.sort(np.array([r.term for r in top.collect()], np.int64).view(np.uint64))
    rows, seen = _document_counts(docs, text, terms)
    idf = np.log((1 + rows) / (1 + seen)) + 1e-3

    kind = T.StructType([T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.FloatType()))])

    @arrow_udf(kind)
    def sparse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in batches:
            found = [v for block in tb.blocks(some) for v in vectors(block, terms, idf)]
            at = [np.flatnonzero(v).astype(np.int32) for v in found]
            columns = [
                pa.array([x.tolist() for x in at], pa.list_(pa.int32())),
                pa.array([v[x].tolist() for v, x in zip(found, at, strict=True)], pa.list_(pa.float32())),
            ]
            yield pa.StructArray.from_arrays(columns, names=["terms", "values"])

    examples = sorted(texts.select("_id", "_toxic", sparse("_text").alias("v")).collect())
    matrix = np.zeros((len(examples), len(terms)), np.float32)
    for k, e in enumerate(examples):
        matrix[k, e.v.terms] = e.v["values"]
    toxic = np.array([e._toxic for e in examples], float)
    share = np.where(toxic == 1, totals.get(1, 0) / max(1.0, n1), totals.get(0, 0) / max(1.0, n0))
    return calibrated(terms, idf, matrix, toxic, share, np.array([e._id for e in examples], np.int64))


def calibrated(terms, idf, matrix, toxic, weight, ids) -> Model:
    """The model of example vectors; ``weight`` is how many labelled rows an example stands for."""
    spoken = np.flatnonzero(matrix.any(axis=1))
    quiet = np.setdiff1d(np.arange(len(matrix)), spoken)
    silent = float((weight[quiet] * toxic[quiet]).sum() / max(1e-9, weight[quiet].sum())) if len(quiet) else float(
        (weight * toxic).sum() / max(1e-9, weight.sum())
    )
    if len(spoken):  # like examples share blocks
        spoken = spoken[np.argsort(matrix[spoken].argmax(axis=1), kind="stable")]
    matrix, toxic, weight, ids = matrix[spoken], toxic[spoken], weight[spoken], ids[spoken]
    index = BlockMaxIndex(matrix)
    beta = np.zeros(3)
    if index.n:
        seen, cosine, _ = votes(index, toxic, weight, matrix, np.arange(index.n))
        beta = _logistic(_inputs(seen, cosine), toxic, weight / weight.mean())
    return Model(terms, idf, index, toxic, weight, ids, beta, silent)


def scorer(model: Model):
    """A function of the text: (score, evidence) with the ids of the nearest examples."""
    kind = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("evidence", T.ArrayType(T.LongType()))])

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            scores, evidence = [np.empty(0)], []
            for block in tb.blocks(texts):
                # at most so many rows of dense vectors at a time, however short the texts are
                found = [model.score(vectors(part, model.terms, model.idf)) for part in _parts(block)]
                scores += [s for s, _ in found]
                evidence += [[int(x) for x in row if x >= 0] for _, e in found for row in e]
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate(scores), pa.float64()), pa.array(evidence, pa.list_(pa.int64()))],
                names=["score", "evidence"],
            )

    return arrow_udf(score, kind)


def _parts(block: tb.Block, rows: int = 2_048) -> Iterator[tb.Block]:
    for start in range(0, block.rows, rows):
        bounds = block.bounds[start : start + rows + 1]
        yield tb.Block(block.data[bounds[0] : bounds[-1]], bounds - bounds[0], block.first + start)


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with a struct ``out``: score (0 to 1) and evidence (ids of the nearest examples).

    Null and empty texts, like all without a known term, get the share of toxic rows among such
    examples, and no evidence. Equal texts get equal scores. A column called ``out`` is replaced.
    """
    return tb.small_batches(docs).withColumn(out, scorer(model)(F.col(text)))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; all columns pass through."""
    out = fresh("_toxicity", docs)
    model = fit(docs, labels, text=text)
    return scored(docs, model, text, out).filter(F.col(out)["score"] < threshold).drop(out)
