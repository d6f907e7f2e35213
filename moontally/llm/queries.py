"""The registered queries of the operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    balanced_shards,
    cost_packing,
    embedding_links,
    personal_data,
    phrase_mining,
    piece_encoding,
    quality_classifier,
    quality_rules,
    quotation_threads,
    repeated_passages,
    simhash_links,
    sketch_search,
    source_mixing,
)
from .common import table
from .oracle import ORACLE  # noqa: F401  the SQL of these queries

#: Labelled rows a classifier learns from at most.
TRAINING_ROWS = 12_000


#: Score from which a document counts as good.
QUALITY = 0.3


def quality_weights(spark: SparkSession, sf_dir: str):
    """Weights learned from the documents table and its labels outside the held-out fifth."""
    labels = table(spark, sf_dir, "labels").where(F.col("quality").isin(0, 1) & ~held_out("doc_id"))
    labels = quality_classifier.sample(labels.select("doc_id", F.col("quality").alias("label")), "doc_id", TRAINING_ROWS)
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_classifier.train(texts.join(labels, "doc_id"), "text", "label", "doc_id")


def held_out(doc_id: str):
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = quality_weights(spark, sf_dir)
    scores = quality_classifier.score(table(spark, sf_dir, "documents"), "doc_id", "text", weights)
    return scores.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= QUALITY).cast("int").alias("predicted")
    )


def model_path() -> str:
    """The SentencePiece model the queries encode with."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix(table(spark, sf_dir, "documents"), "doc_id", "source")


def op3_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = piece_encoding.encode(table(spark, sf_dir, "documents"), "doc_id", "text", model_path())
    return rows.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeated_passages.remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.md5(F.coalesce("text", F.lit(""))).alias("link"),
    )
    rows = balanced_shards.shard(docs, "doc_id", "link", also=("size", "text_crc32"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "linked"
    )


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = personal_data.spans(table(spark, sf_dir, "documents"), "doc_id", "text")
    kinds = [kind.name for kind in personal_data.KINDS if kind.base]
    return rows.select(
        "doc_id", *(personal_data.count("base", kind).alias(f"n_{kind}") for kind in kinds),
        F.sha2(personal_data.listed("base"), 256).alias("base_sha256"), personal_data.listed("spans").alias("spans"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.rules(docs, "doc_id", "text", quality_rules.references(docs, "text", "lang"))


def op8_simhash_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_links.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")
    return rows.select("doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def op9_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op10_quotation_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation_threads.conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")


def op11_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_search.search(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


#: The id that ends a packed document.
END = 2


def op12_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = cost_packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), END)
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.phrases(table(spark, sf_dir, "documents"), "text", "lang")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_quality_classifier,
        op2_source_mixing,
        op3_piece_encoding,
        op4_repeated_passages,
        op5_balanced_shards,
        op6_personal_data,
        op7_quality_rules,
        op8_simhash_links,
        op9_embedding_links,
        op10_quotation_threads,
        op11_sketch_search,
        op12_cost_packing,
        op13_phrase_mining,
    )
}
