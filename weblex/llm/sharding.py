"""Uniform shuffle into shards of exact size, by a hypergeometric
communication matrix.

The rows of a source partition are counted, and the matrix of how many of them
go to each shard is drawn exactly: shard sizes are fixed first (counts at most
one apart), then each partition's row of the matrix is a multivariate
hypergeometric draw from what the shards still lack, one cell at a time from
the exact distribution.  Each partition is permuted by random keys and handed
out by the running sums of its row; after the exchange every shard is permuted
again.  Every assignment of rows to slots is equally likely, and a shard's
size never varies.

Source partitions are folded to at most SOURCES, so the matrix has a fixed
bound; a shard is permuted in buckets of about BUCKET rows (a range of the
random keys each), so no task sorts a whole shard.  Only sizes and checksums
travel, not texts.

Defined results: a null text has size 1 and no checksum; repeated rows are
rows of their own; null ids are allowed; an empty table gives an empty table;
columns other than those named are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SHARDS = 16
SOURCES = 1024
BUCKET = 250_000
MAX_BUCKETS = 4096
SEED = 20_240


def hypergeometric(good: int, total: int, draws: int, rng: np.random.Generator) -> int:
    """How many of ``draws`` out of ``total`` are among ``good``.

    Inverse of the distribution function over the mode +- 12 standard
    deviations (and 60 more); what lies beyond has less than 1e-30."""
    low, high = max(0, draws - (total - good)), min(good, draws)
    if low == high:
        return low
    mean = draws * (good / total)
    sd = (mean * (1 - good / total) * max(total - draws, 1) / max(total - 1, 1)) ** 0.5
    a, b = max(low, int(mean - 12 * sd) - 60), min(high, int(mean + 12 * sd) + 60)
    k = np.arange(a, b, dtype=np.float64)
    logs = np.concatenate([[0.0], np.cumsum(np.log((good - k) * (draws - k)) -
                                            np.log((k + 1) * (total - good - draws + k + 1)))])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return a + int(np.searchsorted(mass, rng.random() * mass[-1], side="right").clip(0, b - a))


def communication_matrix(counts: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Rows of partition p that go to shard s; every row and column sum exact."""
    rng = np.random.default_rng(seed)
    total = sum(counts)
    lacks = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    out = np.zeros((len(counts), shards), np.int64)
    for p, n in enumerate(counts):
        rest, left = int(lacks.sum()), n
        for s in range(shards):
            out[p, s] = hypergeometric(int(lacks[s]), rest, left, rng) if left else 0
            rest -= int(lacks[s])
            left -= int(out[p, s])
        lacks -= out[p]
    return out


def shuffle_into_shards(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` (narrow) plus ``shard`` (int) and ``slot`` (long, gapless from
    0 in each shard)."""
    spark = rows.sparkSession
    cols = rows.columns
    keyed = rows.select(F.struct(*[f"`{c}`" for c in cols]).alias("r"),
                        F.pmod(F.spark_partition_id(), F.lit(SOURCES)).alias("source"),
                        F.monotonically_increasing_id().alias("at"))
    # Stored, so that keys and partitions stay what they are on any retry.
    keyed = stored(keyed, "sharding-rows")
    counts = {r["source"]: r["count"] for r in keyed.groupBy("source").count().collect()}
    sources = sorted(counts)
    matrix = communication_matrix([counts[s] for s in sources], shards, seed)
    total = sum(counts.values())
    bounds = np.cumsum(matrix, axis=1)
    names = ", ".join(["source int"] + [f"b{s} long" for s in range(shards)])
    plan = spark.createDataFrame([(s, *map(int, bounds[i])) for i, s in enumerate(sources)], names)

    local = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "at"), "at")
    ranked = keyed.withColumn("k", F.row_number().over(local) - 1).join(F.broadcast(plan), "source")
    shard = F.lit(0)
    for s in range(shards - 1):
        shard = shard + (F.col("k") >= F.col(f"b{s}")).cast("int")
    buckets = max(1, min(MAX_BUCKETS, -(-total // (shards * BUCKET))))
    key = F.xxhash64(F.lit(seed + 1), "at")
    bucket = F.floor(F.shiftrightunsigned(key, 33) * F.lit(buckets) / F.lit(1 << 31)).cast("int")
    dealt = stored(ranked.select("r", "at", shard.alias("shard"), key.alias("key"), bucket.alias("bucket")),
                   "sharding-dealt")
    sizes = dealt.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # shards * MAX_BUCKETS rows at most.
    offsets = sizes.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    again = Window.partitionBy("shard", "bucket").orderBy("key", "at")
    return (dealt.withColumn("n", F.row_number().over(again) - 1)
            .join(F.broadcast(offsets), ["shard", "bucket"])
            .select("r.*", "shard", (F.col("base") + F.col("n")).cast("long").alias("slot")))
