"""The registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsvar.llm import conversations, decontaminate, jaccard, langid, lm, mixing, pii, quality, resampling, shards, tokencounts, toxicity, urlgraph
from obsvar.llm.textblocks import crc_slot
from obsvar.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_repetition(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.repetition(docs).select("doc_id", "repetition.*")


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, folder, "benchmark")).withColumnRenamed("doc_id", "_id")
    joined = docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_items", "n_overlaps", "best_same")]
    return joined.select("doc_id", F.coalesce(F.col("n_overlaps") > 0, F.lit(False)).alias("contaminated"), *counts, "best_item")


def op3_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", shards.text_size().alias("size"), shards.text_crc().alias("text_crc32")
    )
    placed = shards.balanced_shards(docs, "size", [F.col("doc_id"), F.col("text_crc32"), F.col("size")])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.protected(docs)
    kinds = F.transform("base", lambda s: s.kind)
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)
    ]
    return found.select(
        "doc_id", *counts, F.sha2(pii.rendered(F.col("base")), 256).alias("base_sha256"), pii.rendered(F.col("all")).alias("spans")
    )


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return jaccard.similar_groups(docs, words=4, percent=85)


def op6_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.expr(f"{crc_slot('doc_id')} % 5 = 1")
    found = lm.scored(docs, ~held_out)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.expr(f"{crc_slot('doc_id')} % 5 = 0")
    labels = table(spark, folder, "labels").filter(~held_out)
    found = toxicity.scored(docs, toxicity.fit(docs, labels))
    score = F.col("toxicity.score")
    return found.select(
        "doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"),
        F.col("toxicity.evidence").alias("evidence"),
    )


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "source", "mix.size", "mix.source_size", "mix.target", "mix.epochs", "mix.taken")


#: Fixed rules of the query.
URL_RULES = (
    urlgraph.Rule("allow", "com", "/"),
    urlgraph.Rule("block", "example.com", "/en/"),
    urlgraph.Rule("allow", "www.example.com", "/en/"),
    urlgraph.Rule("block", "net", "/es/"),
    urlgraph.Rule("block", "net", "/fr/"),
)


def op9_url_graph(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return urlgraph.judged(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op10_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.expr(f"{crc_slot('doc_id')} % 3 = 1")
    found = langid.identified(docs.select("doc_id", "text"), langid.fit(docs.filter(~held_out)))
    return found.select(
        "doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score", "language.ambiguous"
    )


def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = resampling.ranked(docs, table(spark, folder, "benchmark").select("text"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.trie(conversations.forked(table(spark, folder, "conversations")))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every call starts with an empty cache of its own, so that its work follows its input."""
    import public_tokenizers  # a package of vocabulary files, which no other query needs

    docs = table(spark, folder, "documents").select("doc_id", "text")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    found = tokencounts.counted(docs, tokenizer, scratch_path(spark, "token-cache"))
    n = F.col("tokens.n_tokens")
    return found.select("doc_id", "tokens.n_bytes", n.alias("n_tokens"), (n > 1024).alias("over_limit"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_repetition,
        op2_decontaminate,
        op3_shards,
        op4_pii,
        op5_jaccard_join,
        op6_lm_scores,
        op7_toxicity,
        op8_mixing,
        op9_url_graph,
        op10_langid,
        op11_resampling,
        op12_prefix_trie,
        op13_token_counts,
    )
}
