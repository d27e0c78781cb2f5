"""The registered queries ``opN_<name>``: each operator, with production
parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, divergence, embedding_groups, licenses, mixing, oracle, packing, quality, sharding, simhash, tokens, topk, toxicity, warc
from .common import table

TOKEN_LIMIT = 512


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.col("text").cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"))
    return sharding.shuffle_into_shards(rows, sharding.SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = simhash.near_duplicates(docs, width=3, max_bits=2, keep=["doc_id"])
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      "component_id", "is_kept")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = toxicity.score(docs, toxicity.fit(docs, labels), keep=["doc_id"])
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Shares of the expected tokens by language; the labelled table's good rows
#: (quality 1) teach what a language looks like, wherever a row came from.
TARGETS = {"en": 0.50, "fr": 0.19, "de": 0.18, "es": 0.13}


def language_labels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled rows marked good."""
    good = labels.where("quality = 1").select("doc_id")
    return (documents.select("doc_id", F.col("lang").alias("domain"))
            .join(good, "doc_id", "left_semi"))


def op4_mixing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mixing.mix(docs, language_labels(docs, labels), TARGETS, keep=["doc_id"])


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.drop("spans")


def op8_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.fresh_folder(spark)
    index = warc.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc.read_records(index, folder).drop("payload")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = tokens.count_tokens(docs, tokenizer_path(), keep=["doc_id"])
    return out.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality.ledger(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return quality.judge(led).withColumn("policy", F.lit(quality.DEFAULT_POLICY))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair(rows, gone=F.col("gone"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_simhash_groups": op2_simhash_groups,
    "op3_toxicity": op3_toxicity,
    "op4_mixing_rates": op4_mixing_rates,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_packing": op6_packing,
    "op7_license_scan": op7_license_scan,
    "op8_warc_bundles": op8_warc_bundles,
    "op9_token_counts": op9_token_counts,
    "op10_quality_rules": op10_quality_rules,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_source_divergence": op12_source_divergence,
    "op13_embedding_groups": op13_embedding_groups,
}

#: The others draw at random, hash with XXH64, tokenize or fit models; tests/llm
#: holds them against brute force, round trips or held-out labels.
SQL: dict[str, str] = {
    "op5_exact_top_k": oracle.top_k_sql(),
    "op7_license_scan": oracle.license_sql(),
    "op8_warc_bundles": oracle.warc_sql(),
    "op10_quality_rules": oracle.quality_sql(),
    "op11_conversation_repair": oracle.repair_sql(),
    "op12_source_divergence": oracle.divergence_sql(),
    "op13_embedding_groups": oracle.embedding_sql(),
}
