"""Per-file distinct, global distinct, adjacent-run dedup, unions."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

# Rows per ordinal bucket for the run dedup (each bucket is one window task).
RUN_BUCKET_ROWS = 1_000_000


def distinct_per_file(df: DataFrame, value: str, file_col: str = "file_path") -> DataFrame:
    """A value once per file (repeats across files stay)."""
    return df.filter(F.col(value).isNotNull()).select(file_col, value).dropDuplicates([file_col, value])


def distinct_sorted(df: DataFrame, value: str) -> DataFrame:
    """D3: global distinct values, ascending (the ``sort -u`` follow-up)."""
    return df.select(value).filter(F.col(value).isNotNull()).distinct().orderBy(value)


#: Which split of a file scan a row is from; pass them as ``split`` below.
SPLIT = ["_file", "_start"]


def with_split(scan: DataFrame) -> DataFrame:
    """A file scan plus the columns SPLIT."""
    return scan.withColumns({"_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start")})


def drop_adjacent_repeats(df: DataFrame, value: str, order: str, bucket_rows: int = RUN_BUCKET_ROWS,
                          split: list[str] | None = None) -> DataFrame:
    """Keep a row when its value differs from the previous non-null one."""
    return mark_runs(df, value, order, "_new", bucket_rows, split).filter("_new").drop("_new")


def mark_runs(df: DataFrame, value: str, order: str, name: str = "is_new", bucket_rows: int = RUN_BUCKET_ROWS,
              split: list[str] | None = None) -> DataFrame:
    """The rows with a value, and whether it differs from the previous one.

    Rows with a null value are skipped and do not break a run.  ``order`` is
    an integral position (line number, id).  ``split`` names columns that tell
    the splits of a file scan apart (see ``with_split``); they are dropped.  If
    the splits hold positions that do not interleave, as lines of files do, no
    row is moved: each task compares its rows, and a split's first row takes
    the last value of the nearest earlier split that has one from a table of a
    row per split.  Otherwise rows are dealt into buckets of ``bucket_rows``
    positions.
    """
    from ..plans.materialize import materialize

    df = df.filter(F.col(value).isNotNull())
    if split is None:
        return _mark_by_bucket(df, value, order, name, bucket_rows)
    edges = materialize(df.groupBy(*split).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"),
                                               F.max(F.col(order).isNull()).alias("_none"),
                                               F.max_by(value, order).alias("_last")), "run-edges")
    in_turn = Window.orderBy("_lo")
    stitched = edges.withColumns({"_carry": F.lag("_last").over(in_turn), "_prev_hi": F.lag("_hi").over(in_turn)})
    meet = stitched.filter("_none OR _prev_hi >= _lo").limit(1)
    if not meet.isEmpty():
        return _mark_by_bucket(df.drop(*split), value, order, name, bucket_rows)
    ship_package(df.sparkSession)
    schema = T.StructType([*df.schema.fields, T.StructField("_edge", T.BooleanType()),
                           T.StructField(name, T.BooleanType())])
    marked = (df.sortWithinPartitions(*split, order)
              .mapInArrow(partial(_mark_sorted, value, split, name), schema))
    carry = F.broadcast(stitched.select(*split, "_carry"))
    first = F.col("_carry").isNull() | (F.col(value) != F.col("_carry"))
    return (marked.join(carry, split, "left")
            .withColumn(name, F.when(F.col("_edge"), first).otherwise(F.col(name)))
            .drop(*split, "_edge", "_carry"))


def _mark_sorted(value: str, split: list[str], name: str, batches):
    """Rows sorted by split and position: whether a row is its split's first,
    and whether its value differs from the row before."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    names = [value, *split]
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        new, edge = np.ones(n, bool), np.ones(n, bool)
        columns = [batch.column(batch.schema.names.index(c)) for c in names]
        differs = [pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False) for c in columns]
        new[1:] = differs[0]
        edge[1:] = np.logical_or.reduce(differs[1:])
        here = [c[0].as_py() for c in columns]
        if last is not None:
            new[0], edge[0] = here[0] != last[0], here[1:] != last[1:]
        last = [c[n - 1].as_py() for c in columns]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edge), pa.array(new)],
                                         names=[*batch.schema.names, "_edge", name])


def _mark_by_bucket(d: DataFrame, value: str, order: str, name: str, bucket_rows: int) -> DataFrame:
    """One window pass per bucket gives each row's predecessor and marks the
    bucket's last row; a bucket's first row takes the last value of the nearest
    earlier non-empty bucket from a table of one row per bucket."""
    d = d.withColumn("_b", F.expr(f"`{order}` div {int(bucket_rows)}"))
    inside = Window.partitionBy("_b").orderBy(order)
    d = (d.withColumn("_prev", F.lag(value).over(inside))
          .withColumn("_is_last", F.lead(order).over(inside).isNull()))
    last = d.filter(F.col("_is_last")).select("_b", F.col(value).alias("_last"))
    carry = last.select("_b", F.lag("_last").over(Window.orderBy("_b")).alias("_carry"))
    prev = F.coalesce(F.col("_prev"), F.col("_carry"))
    return (d.join(carry, "_b", "left")
             .withColumn(name, prev.isNull() | (F.col(value) != prev))
             .drop("_b", "_prev", "_is_last", "_carry"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Concatenate partial results (by column name)."""
    return reduce(lambda a, b: a.unionByName(b), parts)
