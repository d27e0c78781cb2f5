"""Store an intermediate result once when several actions read it.

``parquet`` (default) writes the table under the shared checkpoint folder
and reads it back: lineage is cut, nothing is recomputed if an executor is
lost, and the stored table doubles as a reusable partial result.
``cache`` keeps it in executor memory/disk (recomputed from lineage on
loss); ``none`` leaves the plan as it is.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..session import scratch_path


def materialize(df: DataFrame, name: str, mode: str = "parquet") -> DataFrame:
    if mode == "none":
        return df
    if mode == "cache":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if mode == "parquet":
        spark = df.sparkSession
        path = scratch_path(spark, name)
        df.write.mode("overwrite").parquet(path)
        # The schema is known: reading it back needs no footer-scan job.
        return spark.read.schema(df.schema).parquet(path)
    raise ValueError(f"unknown materialize mode: {mode}")
