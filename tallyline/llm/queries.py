"""The registered query of each operator, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import (
    bpe,
    embedding_dedup,
    fingerprint,
    hard_negatives,
    html_text,
    line_dedup,
    minhash_dedup,
    mixing,
    prefix_trie,
    rank_bpe,
    secrets,
    token_counts,
    toxicity,
)
from tallyline.sources.sinks import materialise, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    docs = documents(spark, sf_dir, "doc_id", "text")
    return bpe.encode(docs, vocabulary, raw="raw", decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("raw", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model).drop("text")
    return scored.select(
        "doc_id",
        (toxicity.fold("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the numbers of its lines and of those that went, and the digest of what is left."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    docs = docs.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long"))
    left = line_dedup.dedup_lines(docs)
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    following = {"text": "next_text", "sketch": "next_sketch"}
    paired = fingerprint.with_next(docs, "doc_id", following, derive=fingerprint.with_sketch)
    changed = paired.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        "sketch",
        "next_sketch",
        fingerprint.edited(F.col("text"), F.col("next_text")).alias("edited"),
    )
    both = fingerprint.with_sketch(changed, "edited", "edited_sketch")
    own, other, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.written(own).alias("fingerprint"),
        fingerprint.written(other).alias("edited_fingerprint"),
        fingerprint.containment(own, other).alias("near_edited"),
        fingerprint.containment(own, following).alias("near_next"),
        fingerprint.resemblance(own, other).alias("jaccard_edited"),
        fingerprint.resemblance(own, following).alias("jaccard_next"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache of its own, so that each run counts every distinct text."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    docs = documents(spark, sf_dir, "doc_id", "text")
    docs = docs.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    counted = token_counts.count_tokens(docs, vocabulary, scratch_path(spark, "token_counts"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    text = html_text.extract_text(pages).drop("html")
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def with_quality(docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with sampling weights ``weight``: 2 and a half for labels of good and bad quality, else 1."""
    labels = docs.sparkSession.read.parquet(f"{sf_dir}/labels.parquet").select(
        F.col("doc_id").alias("__doc_id"), "quality"
    )
    labels = labels.groupBy("__doc_id").agg(F.max("quality").alias("__quality"))
    weight = F.when(F.col("__quality") == 1, 2.0).when(F.col("__quality") == 0, 0.5).otherwise(1.0)
    joined = docs.join(labels.hint("merge"), F.col("doc_id") == F.col("__doc_id"), "left")
    return joined.select(*docs.columns, weight.alias("weight"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "source", mixing.size_of(F.col("text")).alias("size"))
    weighed = materialise(with_quality(docs, sf_dir), "weighed")
    mixed = mixing.mix(weighed, quality="weight")
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir, "doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "entropy")

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(F.col("secrets")).alias("spans"),
    )


def op11_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = documents(spark, sf_dir, "doc_id", "text")
    return rank_bpe.encode(docs, ranks, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh row are moved on by one, and components are whole 256ths."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    moved = (F.col("label") + 1) % 10
    return hard_negatives.hard_negatives(
        rows.select(
            "vec_id",
            F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label")).alias("label"),
            F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector"),
            (F.col("vec_id") % 100 == 0).alias("anchor"),
        )
    )


def with_package(query: Query) -> Query:
    """``query``, with this package on the path of the Python workers wherever the driver was started."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = spark.sparkContext.environment.get("PYTHONPATH", "")
        if ROOT not in path.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, path)))
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Query] = {
    query.__name__: with_package(query)
    for query in (
        op1_bpe,
        op2_embedding_dedup,
        op3_toxicity,
        op4_minhash_dedup,
        op5_line_dedup,
        op6_fingerprint,
        op7_token_counts,
        op8_html_text,
        op9_mixing,
        op10_secrets,
        op11_rank_bpe,
        op12_prefix_trie,
        op13_hard_negatives,
    )
}

ORACLES: dict[str, str] = {"op9_mixing": mixing.ORACLE}
