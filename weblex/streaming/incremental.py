"""Incremental term x domain counts with Structured Streaming.

New URL files dropped into a folder are picked up by a file stream.  Each
micro-batch stores, in a folder of its own, its (term, domain, n) counts, the
domains of its URLs, and the stems of words no batch had before, and publishes
them with one commit record (``commits``), which also holds its statistics.  A
batch that was killed before that left nothing that is read; one that was
published is not stored again when the stream replays it.  So no file is
counted twice, and a run with no new files adds nothing.

``compact`` merges what is stored into one generation of few files and
publishes it the same way.  A reader (``snapshot``) is bound to one generation
and the batches after it, whatever is published later; ``vacuum`` removes
folders that no later reader needs.

The report (T2) is a batch query over a snapshot: merge (A7), then cutoff and
top domains.  Statistics of the run merge, too: exactly from the stored terms
and domains, or from one distinct-count sketch a batch.
"""

from __future__ import annotations

import base64
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import terms
from ..operators.counts import merge_partials
from ..operators.stemming import stem_vocabulary, vocabulary
from ..plans.jobs import term_report
from ..plans.materialize import materialize
from ..sources.lines import number_rows, sample_every_nth
from ..sources.suffixes import SuffixRules
from . import commits

TABLES = {"counts": "term string, domain string, n bigint", "domains": "domain string, urls bigint",
          "stems": "word string, term string"}
STATS = ("processed_urls bigint, unique_domains bigint, unique_terms bigint, total_terms bigint, "
         "batch_id bigint")
FIGURES = ["processed_urls", "unique_domains", "unique_terms", "total_terms"]
SKETCHES = ["domain_sketch", "term_sketch"]


@dataclass(frozen=True)
class Snapshot:
    """What was published at one moment: a generation and the batches after it."""
    spark: SparkSession
    root: str
    records: dict
    generation: int
    folders: tuple[str, ...]

    def table(self, name: str) -> DataFrame:
        paths = [os.path.join(self.root, f, name) for f in self.folders]
        if not paths:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*paths)

    def batches(self) -> list[dict]:
        return [r for n, r in sorted(self.records.items()) if n.startswith("batch-")]


def _log(root: str) -> str:
    return os.path.join(root, "log")


def snapshot(spark: SparkSession, partial_dir: str) -> Snapshot:
    records = commits.published(spark, _log(partial_dir))
    generations = {int(n.partition("-")[2]): r for n, r in records.items() if n.startswith("generation-")}
    last = max(generations, default=0)
    covers = generations[last]["covers"] if last else {}
    folders = [generations[last]["folder"]] if last else []
    for name, r in sorted(records.items()):
        if name.startswith("batch-") and r["batch"] > covers.get(r["query"], -1):
            folders.append(r["folder"])
    return Snapshot(spark, partial_dir, records, last, tuple(folders))


def _write(df: DataFrame, root: str, folder: str, table: str) -> DataFrame:
    path = os.path.join(root, folder, table)
    df.write.parquet(path)
    return df.sparkSession.read.schema(TABLES[table]).parquet(path)


def store_batch(urls: DataFrame, rules: SuffixRules, partial_dir: str, folder: str, known: DataFrame,
                url_col: str = "url", min_len: int = 3) -> dict:
    """Store the tables of one batch of URL lines; its statistics.

    ``known`` has the stems of earlier batches' words: only words that are not
    there are stemmed."""
    recs = terms.url_records(urls, rules, url_col)
    pairs = materialize(terms.word_domain_counts(terms.words_of(recs, min_len, mark_urls=True)), "pairs-marked")
    words = vocabulary(pairs.filter("word IS NOT NULL"), "word", weight="n")
    new = _write(stem_vocabulary(words.join(known, "word", "left_anti")), partial_dir, folder, "stems")
    counts = _write(terms.terms_from_pairs(pairs, min_len, stems=known.unionByName(new)), partial_dir, folder, "counts")
    domains = _write(pairs.filter("word IS NULL").select("domain", F.col("n").alias("urls")),
                     partial_dir, folder, "domains")
    row = _figures(counts, domains, F.hll_sketch_agg("domain").alias("domain_sketch"),
                   F.hll_sketch_agg("term").alias("term_sketch")).first()
    return ({k: row[k] for k in FIGURES}
            | {k: row[k] and base64.b64encode(bytes(row[k])).decode() for k in SKETCHES})  # null: nothing counted


def _sum(col: str, name: str):
    return F.coalesce(F.sum(col), F.lit(0)).cast("bigint").alias(name)


def _figures(counts: DataFrame, domains: DataFrame, *more) -> DataFrame:
    """A6 of stored counts and domains, and further aggregates, in one row."""
    none = F.lit(None).cast("string")
    rows = counts.select("term", "n", none.alias("domain"), none.cast("bigint").alias("urls")).unionByName(
        domains.select(none.alias("term"), none.cast("bigint").alias("n"), "domain", "urls"))
    return rows.agg(*more, _sum("urls", "processed_urls"), F.countDistinct("domain").alias("unique_domains"),
                    F.countDistinct("term").alias("unique_terms"), _sum("n", "total_terms"))


def run_incremental(spark: SparkSession, source_dir: str, partial_dir: str,
                    checkpoint_dir: str, rules: SuffixRules, min_len: int = 3,
                    max_files_per_batch: int | None = None,
                    every: str | None = None, sample_rate: int = 1, compact_after: int | None = None):
    """Process the files not yet seen, then stop (availableNow).

    With ``every`` (e.g. "10 minutes") the query keeps running on that
    processing-time trigger instead, and its handle is returned.  With
    ``sample_rate`` N only every Nth raw line of a batch is counted, blank
    lines included in the numbering, files in path order.  With
    ``compact_after`` N the store is compacted whenever N batches lie outside
    its generation.
    """
    reader = spark.readStream.format("text")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    stream = reader.load(source_dir).select(
        F.col("value").alias("url"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"))
    query: list[str] = []

    def store(batch: DataFrame, batch_id: int) -> None:
        if not query:  # the stream's own name: a new checkpoint starts anew at 0
            query.append(spark.read.json(os.path.join(checkpoint_dir, "metadata")).first()["id"])
        name = f"batch-{query[0]}-{batch_id:010d}"
        now = snapshot(spark, partial_dir)
        if name in now.records:
            return
        if sample_rate > 1:
            lines = number_rows(batch.withColumn("_id", F.monotonically_increasing_id()))
            batch = sample_every_nth(lines, sample_rate, "line_no")
        folder = f"{name}-{uuid.uuid4().hex[:8]}"
        known = now.table("stems")
        record = store_batch(batch.select("url"), rules, partial_dir, folder, known, "url", min_len)
        commits.publish(spark, _log(partial_dir), name,
                        {"query": query[0], "batch": batch_id, "folder": folder} | record)
        if compact_after and len(now.folders) + 1 - (now.generation > 0) >= compact_after:
            compact(spark, partial_dir)

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint_dir)
    if every:
        return writer.trigger(processingTime=every).start()
    running = writer.trigger(availableNow=True).start()
    running.awaitTermination()
    return None


def compact(spark: SparkSession, partial_dir: str) -> bool:
    """Merge a snapshot into a new generation; False if there was nothing to
    merge or another run published that generation first."""
    now = snapshot(spark, partial_dir)
    if len(now.folders) < 2:
        return False
    number = now.generation + 1
    folder = f"generation-{number}-{uuid.uuid4().hex[:8]}"
    merged = {"counts": merge_partials(now.table("counts")),
              "domains": now.table("domains").groupBy("domain").agg(F.sum("urls").alias("urls")),
              "stems": now.table("stems").dropDuplicates(["word"])}
    for name, df in merged.items():
        _write(df, partial_dir, folder, name)
    covers: dict[str, int] = {}
    for r in now.batches():
        covers[r["query"]] = max(covers.get(r["query"], -1), r["batch"])
    return commits.publish(spark, _log(partial_dir), f"generation-{number}", {"folder": folder, "covers": covers})


def vacuum(spark: SparkSession, partial_dir: str) -> list[str]:
    """Remove the folders of published batches and generations that the newest
    generation has taken in; call it when no reader of an older one is left."""
    now = snapshot(spark, partial_dir)
    old = sorted({r["folder"] for r in now.records.values()} - set(now.folders))
    for folder in old:
        commits.remove(spark, os.path.join(partial_dir, folder))
    return old


def read_partials(spark: SparkSession, partial_dir: str) -> DataFrame:
    """Stored counts: (term, domain, n), a pair once a batch or generation."""
    return snapshot(spark, partial_dir).table("counts")


def batch_stats(spark: SparkSession, partial_dir: str) -> DataFrame:
    """Statistics of each published batch (A6 columns and batch_id)."""
    rows = [tuple(r[k] for k in FIGURES) + (r["batch"],) for r in snapshot(spark, partial_dir).batches()]
    return spark.createDataFrame(rows, STATS)


def run_stats(spark: SparkSession, partial_dir: str, approximate: bool = False) -> DataFrame:
    """One row: batches and the four figures of A6 over all of them.

    Distinct domains and terms are counted over the stored ones or, with
    ``approximate``, estimated from the batches' merged sketches."""
    now = snapshot(spark, partial_dir)
    batches = now.batches()
    first = F.lit(len(batches)).cast("bigint").alias("batches")
    if approximate:
        rows = [[r["processed_urls"], r["total_terms"], *(r[k] and bytearray(base64.b64decode(r[k])) for k in SKETCHES)]
                for r in batches]
        df = spark.createDataFrame(rows, "processed_urls bigint, total_terms bigint, domains binary, terms binary")
        return df.agg(first, _sum("processed_urls", "processed_urls"), _estimate("domains", "unique_domains"),
                      _estimate("terms", "unique_terms"), _sum("total_terms", "total_terms"))
    return _figures(now.table("counts"), now.table("domains"), first)


def _estimate(col: str, name: str):
    return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(col)), F.lit(0)).cast("bigint").alias(name)


def merged_counts(spark: SparkSession, partial_dir: str) -> DataFrame:
    """A7 over all stored partials."""
    return _merged(snapshot(spark, partial_dir))


def _merged(now: Snapshot) -> DataFrame:
    counts = now.table("counts")
    return merge_partials(counts) if len(now.folders) > 1 else counts  # alone, a pair is there once


def merged_report(spark: SparkSession, partial_dir: str, share: float = 0.8,
                  max_domains: int = 1000) -> DataFrame:
    """The term report, recomputed over every stored partial."""
    now = snapshot(spark, partial_dir)
    counts = _merged(now)
    return term_report(materialize(counts, "term-domain") if len(now.folders) > 1 else counts, share, max_domains)
