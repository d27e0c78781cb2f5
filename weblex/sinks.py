"""K1, K2: line files and the term CSV report."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER = "term,frequency,domains"


def write_lines(df: DataFrame, col: str, path: str) -> str:
    """K1: one value per line; the output folder is replaced."""
    df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)
    return path


def write_term_csv(report: DataFrame, path: str) -> str:
    """K2: header ``term,frequency,domains``, frequency descending.

    The domain list is one comma-joined field (quoted by the writer).  A
    range-partitioned sort keeps the part files in frequency order.
    """
    (report.select("term", "frequency", "domains")
           .orderBy(F.desc("frequency"), F.asc("term"))
           .write.mode("overwrite").option("header", True).option("escape", '"').csv(path))
    return path


def read_term_csv(spark: SparkSession, path: str) -> DataFrame:
    """Either report read back; a doubled quote stands for one."""
    return spark.read.csv(path, header=True, quote='"', escape='"',
                          schema="term string, frequency bigint, domains string")


def write_term_parquet(report: DataFrame, path: str) -> str:
    """K2, native form: domains kept as array<string>."""
    (report.withColumn("domains", F.split(F.col("domains"), ","))
           .write.mode("overwrite").parquet(path))
    return path


def _report_lines(report: DataFrame) -> DataFrame:
    """(_f, _t, line) of a report: ``term,frequency,"domains"``."""
    return report.select(
        F.col("frequency").cast("bigint").alias("_f"), F.col("term").alias("_t"),
        F.concat_ws(",", F.col("term"), F.col("frequency").cast("string"),
                    F.concat(F.lit('"'), F.replace(F.col("domains"), F.lit('"'), F.lit('""')), F.lit('"'))).alias("line"))


def write_term_report_text(report: DataFrame, path: str) -> str:
    """K2, source byte format: ``term,frequency,"domains"`` with a header.

    The domains field is always quoted and a quote in it doubled (a lenient
    host may hold any character but ``/ ? # @ :``).  Commas part the domains, so
    a domain that holds one reads as two, as in the source's own format.  Lines
    are formatted by built-in expressions; a range-partitioned sort on
    (frequency desc, term) with the header keyed first keeps the part files in
    report order.
    """
    spark = report.sparkSession
    header = spark.createDataFrame([(HEADER,)], "line string") \
        .select(F.lit(None).cast("bigint").alias("_f"), F.lit("").alias("_t"), "line")
    (header.unionByName(_report_lines(report))
           .orderBy(F.desc_nulls_first("_f"), F.asc("_t"))
           .select(F.col("line").alias("value"))
           .write.mode("overwrite").text(path))
    return path


def join_parts(spark: SparkSession, folder: str, target: str, header: str | None = None) -> str:
    """The part files of ``folder``, in order, as the one file ``target``.

    Bytes are copied part by part through the file system, a buffer at a time,
    into a draft beside the target, which takes its place by a rename when it is
    whole: a failure leaves no file, or the earlier one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = new(target).getFileSystem(conf)
    parts = sorted(s.getPath().toString() for s in fs.listStatus(new(folder))
                   if s.getPath().getName().startswith("part-"))
    head, tail = os.path.split(target.rstrip("/"))
    draft = new(os.path.join(head, f".{tail}-{uuid.uuid4().hex}"))
    out = fs.create(draft, False)
    try:
        if header is not None:
            out.write(bytearray((header + "\n").encode("utf-8")))
        for part in parts:
            into = fs.open(new(part))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(into, out, 1 << 20, False)
            finally:
                into.close()
        out.close()
        if fs.exists(new(target)):
            fs.delete(new(target), False)
        if not fs.rename(draft, new(target)):
            raise OSError(f"cannot put {target} in place")
    except BaseException:
        out.close()
        fs.delete(draft, False)
        raise
    return target


def write_single_lines(df: DataFrame, col: str, target: str) -> str:
    """K1 as one file: the values in the frame's order, one a line."""
    from .session import scratch_path
    parts = write_lines(df, col, scratch_path(df.sparkSession, "lines-parts"))
    return join_parts(df.sparkSession, parts, target)


def write_term_report_file(report: DataFrame, target: str) -> str:
    """K2 as one file: the header once, then the lines of
    ``write_term_report_text`` in report order."""
    from .session import scratch_path
    spark = report.sparkSession
    parts = scratch_path(spark, "report-parts")
    (_report_lines(report).orderBy(F.desc("_f"), F.asc("_t"))
     .select(F.col("line").alias("value")).write.text(parts))
    return join_parts(spark, parts, target, HEADER)
