"""Helpers shared by the operators: table reading, row-wise annotation,
tables kept in the shared scratch folder."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import scratch_path, ship_package

#: Rows handed to Python at a time; bounds what a worker holds besides its
#: Arrow batch, whatever the length of the texts.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back:
    cuts lineage, and every later reader sees the same rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give memory that a worker no longer uses back to the system: workers
    outlive their tasks, and the next one's may be of another kind."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def text_slices(texts: pa.Array, rows: int, size: int) -> list[tuple[int, int]]:
    """(first row, number of rows) of slices of at most ``rows`` rows and, unless
    a single text is longer, ``size`` bytes."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    out, i = [], 0
    while i < len(texts):
        before = int(ends[i - 1]) if i else 0
        j = max(i + 1, min(i + rows, int(np.searchsorted(ends, before + size, side="right"))))
        out.append((i, j - i))
        i = j
    return out


def annotate(df: DataFrame, make: Callable, fields: list[T.StructField], text: str = "text",
             keep: list[str] | None = None, slices: Callable | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) of ``df`` plus ``fields`` computed from
    its text column, row by row, without a shuffle.

    ``make()`` runs once a task and returns ``fn(texts) -> list of columns``
    (one Python list or Arrow array per field); ``texts`` holds None for null.
    With ``slices(texts) -> (first row, rows)`` it gets Arrow arrays cut so,
    otherwise lists of SLICE_ROWS texts.
    A kept column whose name equals a result's (in any case) gives way to the
    result.  An empty table gives an empty table.
    """
    spark = df.sparkSession
    ship_package(spark)
    results = {f.name.lower() for f in fields}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in results]
    cols = keep + ([] if text in keep else [text])
    src = df.select(*[f"`{c}`" for c in cols])
    schema = T.StructType([src.schema[c] for c in keep] + list(fields))
    types = [to_arrow_type(f.dataType) for f in fields]
    at, n_keep, names = cols.index(text), len(keep), [f.name for f in schema.fields]

    def run(batches):
        fn = make()
        for batch in batches:
            cuts = (slices(batch.column(at)) if slices else
                    [(i, SLICE_ROWS) for i in range(0, batch.num_rows, SLICE_ROWS)])
            for i, n in cuts:
                part = batch.slice(i, n)
                out = fn(part.column(at) if slices else part.column(at).to_pylist())
                arrays = [part.column(j) for j in range(n_keep)]
                arrays += [x if isinstance(x, pa.Array) else pa.array(x, type=t)
                           for x, t in zip(out, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
            release()

    return src.mapInArrow(run, schema)


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)
