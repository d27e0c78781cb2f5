"""A training-data pipeline of five operators of ``weblex.llm``.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written
as Parquet and read again as the next stage's ``docs``.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblex.llm import mixing, packing, quality, queries, simhash, toxicity
from weblex.llm.common import stored, table


def _carried(docs: DataFrame) -> DataFrame:
    """The rows as a whole beside what the operators read, so that no column of
    theirs meets one of ``docs``; ``_doc.*`` gives the rows back."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    return docs.select(whole, "doc_id", "text")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ledger's policy keeps."""
    led = quality.judge(quality.ledger(_carried(docs), keep=["_doc"]))
    return led.where("kept").select("_doc.*")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; learnt from the labelled among them."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(_carried(docs), model, keep=["_doc"]).where("score < 0.5").select("_doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: that with the smallest id."""
    return simhash.drop_near_duplicates(_carried(docs), width=3, max_bits=2).select("_doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as often as their fitted rate says."""
    labelled = queries.language_labels(docs, table(spark, sf_dir, "labels"))
    mixed = mixing.mix(_carried(docs), labelled, queries.TARGETS, keep=["_doc"])
    return (mixed.where("copies > 0").select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("_doc.*"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, one row each, with their token ids."""
    return packing.pack_documents(docs, queries.tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs


#: No SQL: hashes, tokenizers and fitted models; tests/llm checks each stage.
ORACLE_SQL = None
