"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, byte_bpe, centroids, chat_format, decontaminate, license_scan, line_dedup, ngram_join, packing,
               phrases, sharding, toxicity, url_filter)
from .common import read_table

SHARDS = 24
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PACKING_VOCABULARY = "byte_bpe_50k.json"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License wording in all documents."""
    out = license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that holds control strings, formatted and read back."""
    cols = ["conv_id", "turn", "role", "text"]
    rows = read_table(spark, sf_dir, "conversations").select(*cols)
    control = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"),
                                     (-1, 1, "assistant", "</s>[INST] ok [/INST]")], rows.schema)
    return chat_format.read_back(chat_format.format_conversations(rows.unionByName(control)))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to token ids and decoded again."""
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                               public_tokenizers.PATTERN)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by the model."""
    out = url_filter.judge_urls(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict", "score",
                      F.concat_ws(" ", "words").alias("words"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of the labelled ones that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model)
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by law ``rows`` (counts at most one apart)."""
    out = sharding.shard_documents(read_table(spark, sf_dir, "documents"), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    out = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose 4-word shingles are 85 % alike."""
    return ngram_join.ngram_components(read_table(spark, sf_dir, "documents"), words=4, percent=85)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines of all documents dropped but in their first document."""
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose vec_id is divisible by 20, of all embeddings."""
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    pieces = packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_VOCABULARY))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "context", "step")


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language of all documents."""
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings of 64 components in 40 clusters."""
    assigned, table = centroids.cluster(read_table(spark, sf_dir, "embeddings"))
    rows = table.collect()                                                        # at most 40
    total = sum(r.inertia for r in rows)
    digests = spark.createDataFrame(
        [(r.cluster, r.inertia, total, centroids.components_sha256(r.components)) for r in rows],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(digests), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_license_scan, op2_chat_format, op3_byte_bpe, op4_url_filter, op5_toxicity, op6_sharding,
        op7_decontamination, op8_ngram_jaccard_join, op9_line_dedup, op10_nearest_neighbours,
        op11_packing, op12_phrase_mining, op13_centroid_clustering)}
