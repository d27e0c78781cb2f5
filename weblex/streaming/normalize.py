"""Streaming host normalization, each registered domain emitted once.

Host lines arriving in a folder are mapped to registered domains with the
same per-row suffix lookups as batch jobs (hash-set tests, or stream-static
broadcast joins for very large rule sets; no shuffle of the stream);
``dropDuplicates`` on the domain keeps one state entry per domain seen, so
a domain is appended to the sink only the first time it appears, across
runs.  That state grows with the number of distinct domains, which is
inherent to "emit once"; it lies on the executors' disks (RocksDB), a bounded
part of it in memory, and a checkpoint uploads what changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import strip_text
from ..operators.domains import registered_only
from ..sources.suffixes import SuffixRules


#: State on disk; set in the job's own session.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def normalized_stream(hosts: DataFrame, rules: SuffixRules, col: str = "host") -> DataFrame:
    df = hosts.select(strip_text(F.col(col)).alias(col))
    return registered_only(df, col, rules, stripped=True).dropDuplicates(["domain"])


def run_normalize(spark: SparkSession, source_dir: str, sink_dir: str,
                  checkpoint_dir: str, rules: SuffixRules,
                  state_partitions: int | None = None) -> None:
    """Consume the host files not yet seen; append new domains to the sink.

    ``state_partitions`` sizes the dedup state (fixed by the checkpoint at
    the first run) independently of the batch shuffle setting.  The stream
    runs in a child session with its state on disk, leaving the caller's
    settings alone.
    """
    partitions = str(state_partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    spark = spark.newSession()
    for key, value in {**STATE_CONF, "spark.sql.shuffle.partitions": partitions}.items():
        spark.conf.set(key, value)
    hosts = spark.readStream.format("text").load(source_dir).select(F.col("value").alias("host"))
    query = (normalized_stream(hosts, rules).writeStream
             .format("parquet").outputMode("append")
             .option("path", sink_dir)
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def read_domains(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.schema("domain string").parquet(sink_dir)
