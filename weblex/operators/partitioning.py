"""Input parallelism for the per-row stages.

A scan gets one task per file split (a Parquet row group at least).  On a
cluster the URL corpus has thousands of splits and this does nothing; a
small input held in one or two row groups would otherwise run its whole
per-row pipeline (regexes, suffix lookups, tokenizing) in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Round-robin repartition only when the input has fewer partitions
    than the cluster runs tasks at once (never for large inputs).

    Only plain scans are inspected.  An input that already shuffles has
    shuffle-partition parallelism, and asking an adaptive plan for its
    partitions would run its stages ahead of the query.
    """
    if df.isStreaming:
        return df
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" or "Exchange" in plan.toString():
        return df
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots)
