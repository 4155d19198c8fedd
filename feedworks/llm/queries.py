"""The registered queries of the operators, each over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks.llm import (
    chat_format,
    drift_clusters,
    mixing,
    ngram_join,
    pivot_index,
    projection_tree,
    sentencepiece_codec,
    spelling_groups,
    suffix_shards,
    suffix_tree_lm,
    token_shards,
    toxicity,
    url_filter,
)
from feedworks.llm.common import read_table, shipped
from feedworks.llm.oracles import ORACLES as ORACLES

BYTE_RANKS, BYTE_PATTERN, TEXT_END = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50256
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_codec.encode_and_decode(docs, PIECES)
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.score(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Verdict and rule of the web filter, a rule being a host and the start of a path.
URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    shards, sources = token_shards.write_shards(docs, BYTE_RANKS, BYTE_PATTERN, TEXT_END)
    # Read back from the files: what training would see.
    read = shards.read(spark).withColumn("tokens_sha256", F.sha2("tokens", 256)).drop("tokens")
    return read.join(sources, "sequence").select(
        "slot", "shard", "offset", "sequence", "n_tokens", "tokens_sha256", "doc_ids"
    )


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    # Null and non-finite components stay what they are, so that their vectors take no part.
    whole = F.transform(
        F.col("embedding").cast("array<double>"),
        lambda x: F.when(F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(F.floor(x * 256).cast("double")),
    )
    return pivot_index.exact_top_k(vectors.withColumn("embedding", whole), 5, F.col("vec_id") % 50 == 0, whole=True)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    plan = mixing.mix_plan(docs)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


#: The score from which a text counts as toxic.
TOXIC_FROM = 0.3


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    """A model learned from the labels of the documents that are not held out."""
    labels = read_table(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.learn(docs, labels)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op8_projection_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return projection_tree.approximate_top_k(vectors, 20, F.col("vec_id") % 20 == 0)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    chats = chat_format.format_chats(turns.unionByName(told))
    read = chats.select(
        "conv_id",
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat_format.read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.jaccard_links(docs)


def op11_suffix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = suffix_shards.remove_earlier_passages(docs, window=13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = spelling_groups.count_runs(docs, "doc_id", "text", least=7, drop=31).where("n >= 2")
    return spelling_groups.group_spellings(counts, ratio=10, least=7)


def op13_drift_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    members = drift_clusters.cluster_vectors(vectors, k=8, rounds=10, width=64, scale=1024)
    centroid = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return members.withColumn("centroid_sha256", F.sha2(centroid, 256)).drop("centroid")


QUERIES = {
    query.__name__: shipped(query)
    for query in (
        op1_sentencepiece,
        op2_suffix_tree_lm,
        op3_url_filter,
        op4_token_shards,
        op5_exact_top_k,
        op6_mixing,
        op7_toxicity,
        op8_projection_tree,
        op9_chat_format,
        op10_ngram_join,
        op11_suffix_shards,
        op12_spelling_groups,
        op13_drift_clusters,
    )
}
