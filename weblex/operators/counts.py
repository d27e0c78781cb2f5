"""Extraction and normalization counts, partial merging.
(A6/A8 statistics: ``terms.corpus_stats``.)"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_per_file(distinct_rows: DataFrame, file_col: str = "file_path") -> DataFrame:
    """A1: distinct rows written per file."""
    return distinct_rows.groupBy(file_col).agg(F.count(F.lit(1)).alias("n"))


def normalize_counts(marked: DataFrame, is_new: str = "is_new") -> DataFrame:
    """A2: hosts that got a registered domain, and rows emitted, from one pass
    over the rows marked by ``dedup.mark_runs``."""
    return marked.agg(
        F.count(F.lit(1)).cast("bigint").alias("domain_count"),
        F.coalesce(F.sum(F.col(is_new).cast("bigint")), F.lit(0)).cast("bigint").alias("unique_count"))


def merge_partials(partials: DataFrame, keys=("term", "domain"), n: str = "n") -> DataFrame:
    """Add partial counts per key (map-side partial, then final agg)."""
    return partials.groupBy(*keys).agg(F.sum(n).cast("bigint").alias(n))
