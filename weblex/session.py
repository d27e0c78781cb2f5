"""Spark session defaults and the shared scratch folder.

Everything that has to outlive a task (streaming checkpoints, stored partial
counts, manifests written for a run) goes under the folder the cluster names
in ``spark.checkpoint.dir``.  Only local runs (tests) may do without: they get a
folder of their own; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from measured sizes and
# splits skewed shuffle partitions; the rest keeps local runs quiet.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "weblex", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; create a local one only if none is set."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="weblex-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def ship_package(spark: SparkSession) -> None:
    """Make ``weblex`` importable in executor Python workers.

    Python-side steps (the stemmer, the IDNA rule spelling) run in worker
    processes, which import this package.  It is zipped once per
    SparkContext into the shared checkpoint folder (through the Hadoop file
    system API, so any cluster file system works) and added with
    ``addPyFile``, as a cluster job would ship it with ``--py-files``.
    """
    import io
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_weblex_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    target = os.path.join(checkpoint_root(spark), f"weblex-{uuid.uuid4().hex[:8]}.zip")
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(fs.makeQualified(path).toString())
    sc._weblex_shipped = True
