"""Line files (URLs or hosts, one per line) and every-Nth sampling.

Text files carry no line numbers.  ``numbered_lines`` counts the lines of each
input split, turns those counts (a row per split) into offsets in (file, split)
order and adds a line's position in its split: dense numbers of the raw lines,
blank ones included, and no line is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.urls import strip_text


def read_lines(spark: SparkSession, path: str, col: str = "url") -> DataFrame:
    """Stripped, non-empty lines as ``col``."""
    df = spark.read.text(path).select(strip_text(F.col("value")).alias(col))
    return df.filter(F.col(col) != "")


def number_rows(raw: DataFrame, name: str = "line_no", keep_split: bool = False) -> DataFrame:
    """Add the dense 1-based number of each row of a file scan that carries
    ``_file``, ``_start`` (its split) and ``_id`` (monotonically_increasing_id),
    in file and split order.

    The splits of a scan are planned from the files alone, so the counts and
    the rows see the same ones.  The table of offsets has a row per split and
    is broadcast (some 100 bytes for each 128 MB of lines).  ``keep_split`` keeps
    ``_file`` and ``_start``."""
    splits = raw.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_file", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (raw.join(F.broadcast(offsets), ["_file", "_start"])
            .withColumn(name, F.col("_off") + F.col("_id") - F.col("_first") + 1)
            .drop(*([] if keep_split else ["_file", "_start"]), "_id", "_first", "_off"))


def numbered_lines(spark: SparkSession, path: str, col: str = "url", name: str = "line_no",
                   keep_split: bool = False) -> DataFrame:
    """Every raw line, stripped (blank ones as ''), with its number."""
    raw = spark.read.text(path).select(
        strip_text(F.col("value")).alias(col), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"))
    return number_rows(raw, name, keep_split)


def sample_every_nth(df: DataFrame, n: int, ordinal: str) -> DataFrame:
    """Keep rows whose 1-based position (``ordinal``) is a multiple of n.

    n <= 1 keeps everything.  The position column must be dense (see
    ``operators.ordinal.with_ordinal``).
    """
    if n <= 1:
        return df
    return df.filter(F.col(ordinal) % n == 0)


def hash_sample(df: DataFrame, n: int, col: str = "url", seed: int = 42) -> DataFrame:
    """S5 without an order: a repeatable 1-in-n sample by hash of ``col``."""
    if n <= 1:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit(seed), F.col(col)), F.lit(n)) == 0)


def sample_every_nth_in_split(df: DataFrame, n: int) -> DataFrame:
    """S5 per input range: every Nth row by position inside each split.

    The source samples within each worker's line range; Spark's input
    splits are those ranges here.  The position comes from
    ``monotonically_increasing_id`` (partition index in the upper bits,
    row position in the lower 33), so there is no shuffle and no global
    order.  Apply it directly on a scan: positions follow the split's rows.
    """
    if n <= 1:
        return df
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return df.withColumn("_pos", local).filter(F.col("_pos") % n == 0).drop("_pos")
