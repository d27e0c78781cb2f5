"""Commit records: small files that publish stored tables.

A writer stores its tables in a folder of its own name and then publishes a
record of it with one rename, which either happens or not.  Folders that no
record names (of a run that was killed) are never read, and a record, once
published, is never replaced.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return jvm, path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish(spark: SparkSession, log: str, name: str, record: dict) -> bool:
    """Publish ``record``; False if there is one of that name already."""
    jvm, folder, fs = _fs(spark, log)
    fs.mkdirs(folder)
    target = jvm.org.apache.hadoop.fs.Path(os.path.join(log, name))
    if fs.exists(target):
        return False
    draft = jvm.org.apache.hadoop.fs.Path(os.path.join(log, f".{name}-{uuid.uuid4().hex}"))
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(record).encode("utf-8")))
    finally:
        out.close()
    if fs.rename(draft, target):
        return True
    fs.delete(draft, False)
    return False


def published(spark: SparkSession, log: str) -> dict[str, dict]:
    """The records, by name."""
    jvm, folder, fs = _fs(spark, log)
    if not fs.exists(folder):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    names = sorted(n for n in names if not n.startswith("."))
    if not names:
        return {}
    rows = spark.read.text([os.path.join(log, n) for n in names], wholetext=True).selectExpr(
        "value", "_metadata.file_name AS name").collect()
    return {r["name"]: json.loads(r["value"]) for r in rows}


def remove(spark: SparkSession, folder: str) -> None:
    _, path, fs = _fs(spark, folder)
    fs.delete(path, True)
