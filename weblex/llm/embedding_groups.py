"""Near-duplicate vectors by random-hyperplane signs in several tables.

Vectors are compared within their label only.  A table gives a vector the
signs of its products with ``bits`` random hyperplanes; two vectors at angle a
agree in all of them with probability (1 - a / pi) ** bits.  The number of
bits follows the largest label (buckets of about TARGET vectors), the number
of tables the bits, so that a pair right at the threshold shares some bucket
with probability RECALL; closer pairs do so more surely.  All pairs of a bucket
are verified by their cosine in double precision, and a pair counts in the
first table only that brings it together.  Pairs never leave a task: it reports
each vector's number of links and a spanning forest, whose edges
``components`` joins up.

Large buckets.  Vectors within half the threshold's angle of one pivot are all
linked with each other.  While buckets of more than BLOCK vectors are left, up
to ROUNDS pivots a bucket take such vectors (copies and near copies) into
*balls*, whose links are counted from the ball's size, without comparing.
What remains of a bucket is cut into blocks of about BLOCK vectors; every two
blocks meet in a cell of their own, except blocks of the same ball.

Defined results: vectors that are null, empty or zero, or hold null or
non-finite components, and vectors with a null label, link with nothing;
vectors of different length do not link; each row is a vector (repeated rows
link with each other); null ids are ignored in a component's smallest id; an
empty table gives an empty table; columns other than those named are not read.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import stored
from .components import components, unite

THRESHOLD = 0.93
#: Probability that a pair at the threshold shares a bucket.
RECALL = 0.999
#: Vectors a bucket should have, where they lie evenly.
TARGET = 256
BLOCK = 2048
ROUNDS = 3
MIN_BITS, MAX_BITS = 4, 40
SEED = 29
#: Rows of a product of vectors looked at together.
STRIP = 256


def plan_tables(most: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for labels of at most ``most`` vectors."""
    bits = min(MAX_BITS, max(MIN_BITS, round(math.log2(max(1, most) / TARGET))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def usable(vector: Column, label: Column) -> Column:
    """Whether a vector can be linked at all."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) |
                   (F.abs(x.cast("double")) == F.lit(float("inf"))))
    some = F.exists(vector, lambda x: x.cast("double") != 0)
    return F.coalesce(label.isNotNull() & vector.isNotNull() & ~bad & some, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long vectors as rows, each scaled by a power of two (which
    changes no cosine) so that no product overflows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = flat.reshape(len(column), -1)
    return np.ldexp(out, -np.frexp(np.abs(out).max(axis=1))[1][:, None])


def signatures(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """A signature per vector and table.  Vectors and hyperplanes are rounded
    to integers, whose sums are exact, so copies get the same signs."""
    dim = vectors.shape[1]
    planes = np.rint(np.random.default_rng([SEED, dim]).standard_normal((tables * bits, dim)) * 1024).T
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    signs = (np.rint(unit * (1 << 20)) @ planes) >= 0
    weights = np.int64(1) << np.arange(bits, dtype=np.int64)
    return signs.reshape(len(vectors), tables, bits) @ weights


def _signer(bits: int, tables: int, batches):
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            part = batch.take(pa.array(np.flatnonzero(dims == dim)))
            for i in range(0, part.num_rows, 1024):
                rows = part.slice(i, 1024)
                found = signatures(_matrix(rows.column("v")), bits, tables)
                sigs = pa.ListArray.from_arrays(np.arange(0, found.size + 1, tables, dtype=np.int32), found.ravel())
                yield pa.RecordBatch.from_arrays([*rows.columns, sigs], names=[*rows.schema.names, "sigs"])


def _cosine(a: Column, b: Column) -> Column:
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")),
                           F.lit(0.0), lambda s, p: s + p)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


BUCKET = ["label", "dim", "tab", "sig"]


def _with_balls(rows: DataFrame, threshold: float, tables: int) -> DataFrame:
    """``rows`` plus ``ball``: its pivot's uid, or null outside balls."""
    rows = rows.withColumn("ball", F.lit(None).cast("long"))
    inside = math.sqrt((1 + threshold) / 2) + 1e-9  # cosine of half the angle
    for r in range(min(ROUNDS, tables)):
        free = rows.where("ball IS NULL").withColumn("sig", F.col("sigs")[r])
        pivot = F.min_by(F.struct("uid", "v"), F.xxhash64(F.lit(r), "uid"))
        pivots = stored(free.groupBy("label", "dim", "sig").agg(F.count(F.lit(1)).alias("n"), pivot.alias("pivot"))
                        .where(F.col("n") > BLOCK).select("label", "dim", "sig", F.col("pivot.uid").alias("p_uid"),
                                                          F.col("pivot.v").alias("p_v")), "vector-pivots")
        if pivots.isEmpty():
            break
        near = F.col("ball").isNull() & (_cosine(F.col("v"), F.col("p_v")) >= inside)
        rows = stored(rows.withColumn("sig", F.col("sigs")[r]).join(pivots, ["label", "dim", "sig"], "left")
                      .withColumn("ball", F.when(F.coalesce(near, F.lit(False)), F.col("p_uid"))
                                  .otherwise(F.col("ball"))).drop("sig", "p_uid", "p_v"), "vector-balls")
    return rows


def _pairs(v, norm, sigs, tab, left, right, threshold):
    """Strips of (a, b): linked positions that no earlier table has together."""
    for i in range(0, len(left), STRIP):
        rows = left[i:i + STRIP]
        cos = (v[rows] @ v[right].T) / (norm[rows][:, None] * norm[right][None, :])
        a, b = np.nonzero(cos >= threshold)
        a, b = rows[a], right[b]
        if right is left:
            a, b = a[b > a], b[b > a]
        for j in range(0, len(a), 1 << 16):
            x, y = a[j:j + (1 << 16)], b[j:j + (1 << 16)]
            if tab:
                fresh = ~(sigs[x, :tab] == sigs[y, :tab]).any(axis=1)
                x, y = x[fresh], y[fresh]
            if len(x):
                yield x, y


def _verify_cell(cell: pa.Table, threshold: float):
    """(uid, links found here, least uid of its group here) of linked rows."""
    if cell.num_rows < 2:
        return None
    cell = cell.combine_chunks()
    v = _matrix(cell.column("v").combine_chunks())
    norm = np.sqrt((v * v).sum(axis=1))
    tab = cell.column("tab")[0].as_py()
    sigs = cell.column("before").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(v), tab)
    uid, mine = cell.column("uid").to_numpy(), cell.column("mine").to_numpy()
    order = np.argsort(uid)
    v, norm, sigs, uid, mine = v[order], norm[order], sigs[order], uid[order], mine[order]
    left, right = (np.flatnonzero(mine == cell.column(c)[0].as_py()) for c in ("i", "j"))
    if cell.column("i")[0].as_py() == cell.column("j")[0].as_py():
        right = left
    labels, n = np.arange(len(uid)), np.zeros(len(uid), np.int64)
    for a, b in _pairs(v, norm, sigs, tab, left, right, threshold):
        n += np.bincount(a, minlength=len(n)) + np.bincount(b, minlength=len(n))
        other = labels[a] != labels[b]
        labels = unite(labels, a[other], b[other])
    linked = np.flatnonzero(n)
    if not len(linked):
        return None
    return pa.RecordBatch.from_arrays([pa.array(uid[linked]), pa.array(n[linked]), pa.array(uid[labels[linked]])],
                                      names=["uid", "n", "root"])


CELL = [*BUCKET, "i", "j"]


def _verifier(threshold: float, batches):
    """Cells one after the other from rows sorted by cell."""
    held: list[pa.RecordBatch] = []

    def done():
        return _verify_cell(pa.Table.from_batches(held), threshold) if held else None

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [np.asarray(batch.column(c).to_pylist(), object) for c in CELL]
        change = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            change |= k[1:] != k[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(k[a] for k in keys)
            if key != last:
                if (out := done()) is not None:
                    yield out
                held, last = [], key
            held.append(batch.slice(a, b - a))
    if (out := done()) is not None:
        yield out


def links(rows: DataFrame, tables: int, threshold: float = THRESHOLD) -> DataFrame:
    """(uid, n, root): numbers of links and edges to be added up, from stored
    ``rows`` (uid, label, dim, v, sigs, ball)."""
    spread = rows.select("uid", "label", "dim", "v", "sigs", "ball", F.posexplode("sigs").alias("tab", "sig"))
    group = [*BUCKET, "ball"]
    bucket = Window.partitionBy(*BUCKET)
    parts = (spread.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int"))
             .withColumn("all", F.sum("blocks").over(bucket).cast("int"))
             .withColumn("balls", F.count("ball").over(bucket))
             .where((F.col("all") > 1) | (F.col("balls") > 0))
             .withColumn("first", (F.sum("blocks").over(bucket.orderBy(F.col("ball").asc_nulls_first()))
                                   - F.col("blocks")).cast("int")))
    parts = stored(parts.select(*[F.col(c).alias("p_" + c) for c in group], "blocks", "all", "first"), "vector-parts")
    same = F.lit(True)
    for c in BUCKET:
        same &= spread[c] == parts["p_" + c]
    placed = (spread.join(parts, same & spread["ball"].eqNullSafe(parts["p_ball"]), "left")
              .withColumn("first", F.coalesce("first", F.lit(0)))
              .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
              .withColumn("all", F.coalesce("all", F.lit(1)))
              .withColumn("mine", (F.col("first") + F.pmod(F.xxhash64(F.lit(3), "uid"), F.col("blocks"))).cast("int")))
    meets = F.filter(F.sequence(F.lit(0), F.col("all") - 1),
                     lambda j: F.col("ball").isNull() | (j < F.col("first")) | (j >= F.col("first") + F.col("blocks")))
    cells = (placed.withColumn("other", F.explode(meets))
             .select("uid", *BUCKET, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                     "mine", "v", F.slice("sigs", F.lit(1), F.col("tab")).alias("before")))
    return (cells.repartition(*CELL).sortWithinPartitions(*CELL)
            .mapInArrow(partial(_verifier, threshold), "uid long, n long, root long"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept), a row per row of ``vectors``."""
    spark = vectors.sparkSession
    ship_package(spark)
    every = stored(vectors.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
                                  F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v"),
                                  usable(F.col(vector_col), F.col(label_col)).alias("usable")), "vector-rows")
    rows = every.where("usable").select("uid", "label", F.size("v").alias("dim"), "v")
    most = rows.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(most, threshold)
    schema = T.StructType([*rows.schema.fields, T.StructField("sigs", T.ArrayType(T.LongType()))])
    signed = stored(rows.mapInArrow(partial(_signer, bits, tables), schema), "vector-signs")
    signed = _with_balls(signed, threshold, tables)
    found = stored(links(signed, tables, threshold), "vector-links")
    sizes = stored(signed.where("ball IS NOT NULL").groupBy("ball").agg((F.count(F.lit(1)) - 1).alias("n")),
                   "vector-ball-sizes")
    inside = signed.where("ball IS NOT NULL").select("uid", "ball").join(sizes, "ball").select("uid", "n", "ball")
    counts = (found.select("uid", "n").unionByName(inside.select("uid", "n"))
              .groupBy("uid").agg(F.sum("n").alias("n")).where("n > 0"))
    roots = components(found.select(F.col("uid").alias("a"), F.col("root").alias("b"))
                       .unionByName(inside.select(F.col("uid").alias("a"), F.col("ball").alias("b"))))
    linked = stored(every.select("uid", "id").join(counts, "uid")
                    .join(roots, F.col("uid") == F.col("node"), "left")
                    .select("uid", "id", "n", F.coalesce("root", "uid").alias("root")), "vector-linked")
    best = stored(linked.groupBy("root").agg(F.min("id").alias("best")), "vector-best")
    named = linked.join(best, "root").select("uid", "n", "best")
    component = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("best"))
    return (every.select("uid", "id").join(named, "uid", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))
