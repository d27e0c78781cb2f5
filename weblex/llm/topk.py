"""Exact top-k inner products by block-at-a-time pruning.

Vectors are quantised to integers; a term is a component.  Rows are put in the
order of a locality key (which of two sampled rows is nearer, for BITS pairs),
so neighbours are alike, and cut into chunks of about CHUNK rows (at most
MAX_CHUNKS, whose summaries are sent to every task), a chunk into blocks of
BLOCK.  Chunks and blocks keep each term's maximum and minimum; the bound of a
query is the sum over terms of its larger product with these two.  A block's
forward index is its rows.

A query is asked in its own chunk first, which gives it a kth score.  Then it
goes to those other chunks whose bound reaches that score, and in a chunk
blocks are scored in descending order of bounds until the next bound is below
the kth score so far (an equal bound is still scored, since ties go to smaller
ids).  A row is dealt to its chunk's task twice; a task holds one chunk and
takes its queries QUERIES at a time.

Sums are taken in float64 when no sum of products can reach 2^53, otherwise
in Python integers.  Scores outside 64 bits raise an error.

Defined results: vectors that are null, or hold null or non-finite components,
take no part; vectors of different lengths are compared over the shorter
one's components (the rest counts as 0); equal scores rank by smaller id, then
rows with the same id follow each other; a query never meets rows of its own
id; a null id takes no part; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import stored

K = 20
BLOCK = 64
CHUNK = 16_384
#: Chunks at most: two rows of components each are sent to every task.
MAX_CHUNKS = 16_384
#: Pairs of sampled rows in the locality key.
BITS = 32
QUERIES = 2_048
SCALE = 64


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as long; null if any is unusable."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) |
                   (F.abs(x.cast("double")) == F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(vector.isNotNull() & ~bad, whole)


def _matrix(column: pa.Array, dim: int, exact: bool) -> np.ndarray:
    """Vectors as rows, short ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dim), object if exact else np.float64)
    out[np.arange(dim) < sizes[:, None]] = flat.astype(object) if exact else flat
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best, by score descending, then id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    return np.lexsort((ids, -scores))[:k]


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Most that each query can score with rows between ``low`` and ``high``."""
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


class Chunk:
    """Rows in locality order, cut into blocks."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, block: int = BLOCK):
        self.vectors, self.ids, self.block = vectors, ids, block
        self.starts = np.arange(0, len(ids), block)
        self.high = np.maximum.reduceat(vectors, self.starts, axis=0)
        self.low = np.minimum.reduceat(vectors, self.starts, axis=0)
        self.scored = self.asked = 0  # blocks

    def search(self, queries: np.ndarray, query_ids: np.ndarray, k: int,
               floors: np.ndarray | None = None) -> list[tuple[int, int, object]]:
        """(query position, id, score) of each query's k best rows; rows below
        its floor may be left out."""
        ahead = bounds(queries, self.high, self.low)
        by_bound = np.argsort(-ahead, axis=1, kind="stable")
        out: list[tuple[int, int, object]] = []
        for q in range(len(queries)):
            best_s, best_i = np.zeros(0, self.vectors.dtype), np.zeros(0, np.int64)
            i, step, order, mine = 0, max(1, k // self.block + 1), by_bound[q], ahead[q]
            if floors is not None:
                order = order[mine[order] >= floors[q]]
            while i < len(order):
                now = order[i:i + step]
                if len(best_i) == k:
                    # Every block whose bound reaches the kth score, a few at a time.
                    now = now[mine[now] >= best_s[-1]]
                    if not len(now):
                        break
                at = (self.starts[now][:, None] + np.arange(self.block)).ravel()
                at = at[at < len(self.ids)]
                at = at[self.ids[at] != query_ids[q]]
                self.scored += len(now)
                s = np.concatenate([best_s, self.vectors[at] @ queries[q]])
                c = np.concatenate([best_i, self.ids[at]])
                top = _best(s, c, k)
                best_s, best_i = s[top], c[top]
                i, step = i + step, min(2 * step, 64)
            out += [(q, int(c), s) for c, s in zip(best_i, best_s)]
        self.asked += len(queries) * len(self.starts)
        return out


def _locality(sample: np.ndarray, dim: int, exact: bool, batches):
    """The rows plus ``place``: a bit per pair of sampled rows, set where the
    second is the nearer one."""
    a, b = sample[0::2], sample[1::2]
    n = min(len(a), len(b))
    planes, middle = (b[:n] - a[:n]).T, ((b[:n] * b[:n]).sum(axis=1) - (a[:n] * a[:n]).sum(axis=1)) / 2
    weights = (np.int64(1) << np.arange(n, dtype=np.int64))[::-1]
    for batch in batches:
        for i in range(0, batch.num_rows, 4096):
            part = batch.slice(i, 4096)
            v = _matrix(part.column("v"), dim, False)
            place = ((v @ planes > middle) @ weights) if n else np.zeros(len(v), np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(place.astype(np.int64))],
                                             names=[*part.schema.names, "place"])


def _summaries(dim: int, batches):
    """(chunk, high, low) of the parts of chunks met."""
    for batch in batches:
        chunks = batch.column("chunk").to_numpy()
        cuts = [0, *(np.flatnonzero(chunks[1:] != chunks[:-1]) + 1).tolist(), len(chunks)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                v = _matrix(batch.column("v").slice(a, b - a), dim, False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(chunks[a])], pa.int32()), pa.array([v.max(axis=0).tolist()]), pa.array([v.min(axis=0).tolist()])],
                    names=["chunk", "high", "low"])


def _router(numbers: np.ndarray, high: np.ndarray, low: np.ndarray, exact: bool, batches):
    """(chunk, id, v, floor) of the other chunks that a query's floor lets in."""
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            floors = part.column("floor").to_numpy(zero_copy_only=False).astype(float)
            floors = np.where(np.isnan(floors), -np.inf, floors)
            q = _matrix(part.column("v"), high.shape[1], False)
            reach = np.ones((len(q), len(numbers)), bool) if exact else bounds(q, high, low) >= floors[:, None]
            reach &= numbers[None, :] != part.column("chunk").to_numpy()[:, None]
            at, to = np.nonzero(reach)
            if len(at):
                rows = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[to]), rows.column("id"), rows.column("v"), rows.column("floor")],
                    names=["chunk", "id", "v", "floor"])


FOUND = "query_id long, vec_id long, score long, scored long, asked long"


def _searcher(k: int, dim: int, exact: bool, batches):
    """Chunks one after the other: their rows, then their queries."""
    number = chunk = None
    rows: list[pa.RecordBatch] = []

    def ask(part):
        nonlocal chunk
        if chunk is None:
            if not rows:
                return None
            ids = np.concatenate([r.column("id").to_numpy() for r in rows])
            chunk = Chunk(np.concatenate([_matrix(r.column("v"), dim, exact) for r in rows]), ids)
            rows.clear()
        ids = part.column("id").to_numpy()
        floors = part.column("floor").to_numpy(zero_copy_only=False).astype(float)
        before = chunk.scored, chunk.asked
        found = chunk.search(_matrix(part.column("v"), dim, exact), ids, k, np.where(np.isnan(floors), -np.inf, floors)
                             if not exact else None)
        scores = [int(s) for _, _, s in found]
        if any(not -(1 << 63) <= s < 1 << 63 for s in scores):
            raise OverflowError("an inner product does not fit 64 bits")
        n = len(found)
        if not n:
            return None
        # The numbers of blocks stand in the first row.
        spent = [chunk.scored - before[0], chunk.asked - before[1]]
        return pa.RecordBatch.from_arrays(
            [pa.array([int(ids[i]) for i, _, _ in found]), pa.array([v for _, v, _ in found]),
             pa.array(scores, pa.int64()), pa.array([spent[0]] + [0] * (n - 1)), pa.array([spent[1]] + [0] * (n - 1))],
            names=[x.split()[0] for x in FOUND.split(", ")])

    for batch in batches:
        if not batch.num_rows:
            continue
        chunks, asks = batch.column("chunk").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
        change = (chunks[1:] != chunks[:-1]) | (asks[1:] != asks[:-1])
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(chunks)]
        for a, b in zip(cuts, cuts[1:]):
            if chunks[a] != number:
                number, chunk, rows = chunks[a], None, []
            if not asks[a]:
                rows.append(batch.slice(a, b - a))
                continue
            for i in range(a, b, QUERIES):
                if (out := ask(batch.slice(i, min(QUERIES, b - i)))) is not None:
                    yield out


def _search(kept: DataFrame, asked: DataFrame, k: int, dim: int, exact: bool, chunks: int) -> DataFrame:
    none = F.lit(None).cast("double")
    rows = kept.select("chunk", F.lit(False).alias("asks"), "place", "id", "v", none.alias("floor")).unionByName(
        asked.select("chunk", F.lit(True).alias("asks"), F.lit(0).cast("long").alias("place"), "id", "v", "floor"))
    return (rows.repartition(chunks, "chunk").sortWithinPartitions("chunk", "asks", "place", "id")
            .mapInArrow(partial(_searcher, k, dim, exact), FOUND))


def candidates(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id",
               vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, vec_id, score, scored, asked): at least the k best of every
    query row; the sums of the last two tell the share of blocks scored of all
    that the queries' chunks have."""
    ship_package(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("asks"),
                          F.monotonically_increasing_id().alias("at"))
    rows = stored(rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()), "topk-vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0)).alias("q"),
                    F.max(F.size("v")).alias("dim"),
                    F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))).alias("top")).first()
    dim, n = max(1, size["dim"] or 0), size["n"]
    exact = not dim * (size["top"] or 0) ** 2 < 2 ** 53
    rows_a_chunk = max(CHUNK, -(-n // MAX_CHUNKS))
    chunks = max(1, -(-n // rows_a_chunk))
    # A bounded sample; the key only decides which rows lie side by side.
    picked = rows.orderBy(F.xxhash64(F.lit(5), "at"), "at").limit(2 * BITS).select("v").collect()
    sample = np.zeros((len(picked), dim))
    for i, r in enumerate(picked):
        sample[i, :len(r["v"])] = r["v"]
    schema = T.StructType([*rows.schema.fields, T.StructField("place", T.LongType())])
    placed = rows.mapInArrow(partial(_locality, sample, dim, exact), schema)
    placed = stored(placed.repartitionByRange(chunks, "place", "id", "at").sortWithinPartitions("place", "id")
                    .withColumn("chunk", F.spark_partition_id()), "topk-chunks")
    kept = placed.select("chunk", "place", "id", "v")
    # Rows with the same id as a query are asked once.
    asked = placed.where("asks").groupBy("id", "v").agg(F.min("chunk").alias("chunk"))
    asked = stored(asked.withColumn("floor", F.lit(None).cast("double")), "topk-queries")
    near = stored(_search(kept, asked, k, dim, exact, chunks), "topk-own-chunks")
    # At most MAX_CHUNKS rows of two vectors.
    parts = placed.select("chunk", "v").mapInArrow(partial(_summaries, dim), "chunk int, high array<double>, low array<double>")
    numbers, high, low = _merged(parts, dim)
    floors = near.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    floors = floors.where(F.col("n") >= k).select(F.col("query_id").alias("id"), F.col("least").cast("double").alias("floor"))
    # Several vectors of one id: their floors are each other's, so none is used.
    single = asked.groupBy("id").count().where("count = 1").select("id")
    sure = asked.drop("floor").join(floors.join(single, "id", "left_semi"), "id", "left")
    routed = (sure.select("chunk", "id", "v", "floor")
              .mapInArrow(partial(_router, numbers, high, low, exact), "chunk int, id long, v array<bigint>, floor double"))
    far = _search(kept, routed, k, dim, exact, chunks)
    return near.unionByName(far)


def _merged(parts: DataFrame, dim: int):
    """Chunk numbers and their summaries, from those of their parts."""
    every = parts.groupBy("chunk").agg(*[F.max(F.col("high")[d]).alias(f"h{d}") for d in range(dim)],
                                       *[F.min(F.col("low")[d]).alias(f"l{d}") for d in range(dim)])
    found = sorted(every.collect())
    return (np.array([r[0] for r in found], np.int32), np.array([r[1:1 + dim] for r in found], float).reshape(-1, dim),
            np.array([r[1 + dim:] for r in found], float).reshape(-1, dim))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every query row."""
    found = candidates(vectors, is_query, k, id_col, vector_col, scale)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
