"""Near-duplicates by SimHash over a Gray-order hierarchical index.

A fingerprint is the majority vote, bit by bit, of the XXH64 (seed 42) of a
text's word shingles.  Two documents are linked when their fingerprints differ
in at most ``max_bits`` bits; groups are the connected components.

Distinct fingerprints are sorted by Gray rank, so neighbours share many bits,
and cut into blocks of about BLOCK fingerprints (never more than MAX_BLOCKS
blocks, so the table of block summaries has a fixed bound).  Every node of the
index stands for FANOUT neighbours and keeps the bits they all share that no
ancestor holds already; a search adds up the differences on its way down and
drops a whole group once the sum exceeds ``max_bits``.  The upper index over
the blocks routes each fingerprint to the blocks it may link into (from its
own block on: links are symmetric); one task builds the index of one block and
searches it for a slice of at most SLICE queries, then reports a spanning
forest of the links found, never the links themselves.  Components of the
forests' edges follow by ``components``.

Defined results: null text counts as empty; a text without words has
fingerprint zero and is linked like any other; fewer words than a shingle give
one shingle of all; copies and repeated rows share their fingerprint and so
their group; null ids are ignored when a group's smallest id is chosen (null
if there is no other); an empty table gives an empty table; columns other than
those named are not read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import annotate, field, stored
from .components import components, unite

SEED = 42
BLOCK = 65_536
MAX_BLOCKS = 4096
SLICE = 262_144
FANOUT = 16
#: Numbers of rows to drop that are sent to every task, 8 bytes each.
BROADCAST_ROWS = 4_000_000
#: (query, node) pairs looked at together in a search.
FRONTIER = 1 << 19
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


# -- fingerprints ---------------------------------------------------------

def fingerprint(text: str | None, width: int = 3) -> int:
    """The 64-bit fingerprint of ``text``, as a signed number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < width:
        runs = [b" ".join(words)]
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    h = np.fromiter(map(digest, runs), np.uint64)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(h), 32768):
        bits = np.unpackbits(h[i:i + 32768].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * votes > len(h), bitorder="little").view(np.int64)[0])


def _fingerprinter(width: int):
    return lambda texts: [[fingerprint(t, width) for t in texts]]


def fingerprints(docs: DataFrame, width: int = 3, text: str = "text",
                 keep: list[str] | None = None, name: str = "fp") -> DataFrame:
    """``docs`` plus its fingerprint (long, two's complement)."""
    return annotate(docs, partial(_fingerprinter, width), [field(name, T.LongType())], text, keep)


# -- the index ------------------------------------------------------------

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each 64-bit code in the Gray sequence."""
    r = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def gray_rank_column(fp: Column) -> Column:
    """gray_rank as a signed column that sorts like the unsigned rank."""
    r = fp
    for s in (1, 2, 4, 8, 16, 32):
        r = r.bitwiseXOR(F.shiftrightunsigned(r, s))
    return r.bitwiseXOR(F.lit(-(1 << 63)).cast("bigint"))


class GrayIndex:
    """Hierarchy over items in Gray order; an item is a pattern with a mask of
    the bits it fixes (all of them for a fingerprint)."""

    def __init__(self, pattern: np.ndarray, mask: np.ndarray | None = None):
        mask = np.full(len(pattern), ONES) if mask is None else mask
        levels = [(mask, pattern & mask)]
        while len(levels[-1][0]) > FANOUT:
            m, p = levels[-1]
            starts = np.arange(0, len(m), FANOUT)
            ones = np.bitwise_and.reduceat(p, starts)
            shared = np.bitwise_and.reduceat(m, starts) & ~(ones ^ np.bitwise_or.reduceat(p, starts))
            levels.append((shared, ones & shared))
        self.levels = []
        for i, (m, p) in enumerate(levels):
            if i + 1 < len(levels):
                m = m & ~np.repeat(levels[i + 1][0], FANOUT)[:len(m)]
            self.levels.append((m, p & m))

    def search(self, codes: np.ndarray, limit: int):
        """Yield (query numbers, item numbers) of all pairs whose fixed bits
        differ in at most ``limit`` places."""
        top = len(self.levels) - 1
        n_top = len(self.levels[top][0])
        step = max(1, FRONTIER // max(1, n_top))
        for i in range(0, len(codes), step):
            q = np.arange(i, min(len(codes), i + step))
            stack = [(top, np.repeat(q, n_top), np.tile(np.arange(n_top), len(q)), None)]
            while stack:
                level, q, node, so_far = stack.pop()
                mask, pattern = self.levels[level]
                diff = np.bitwise_count((codes[q] ^ pattern[node]) & mask[node])
                if so_far is not None:
                    diff = diff + so_far
                near = diff <= limit
                q, node, diff = q[near], node[near], diff[near]
                if level == 0:
                    if len(q):
                        yield q, node
                    continue
                width = len(self.levels[level - 1][0])
                part = FRONTIER // FANOUT
                for j in range(0, len(q), part):
                    child = (node[j:j + part, None] * FANOUT + np.arange(FANOUT)).ravel()
                    inside = child < width
                    stack.append((level - 1, np.repeat(q[j:j + part], FANOUT)[inside], child[inside],
                                  np.repeat(diff[j:j + part], FANOUT)[inside]))


def _forest(max_bits: int, key, pdf):
    """Spanning forest of the links between a block and a slice of queries."""
    import pandas as pd
    codes = pdf["fp"].to_numpy().view(np.uint64)
    nodes = np.unique(codes)
    member = np.unique(codes[pdf["member"].to_numpy()])
    member = member[np.argsort(gray_rank(member), kind="stable")]
    query = np.unique(codes[pdf["asks"].to_numpy()])
    labels = np.arange(len(nodes))
    at_member, at_query = np.searchsorted(nodes, member), np.searchsorted(nodes, query)
    if len(member) and len(query):
        for q, m in GrayIndex(member).search(query, max_bits):
            a, b = at_query[q], at_member[m]
            other = labels[a] != labels[b]
            if other.any():
                labels = unite(labels, a[other], b[other])
    moved = np.flatnonzero(labels != np.arange(len(nodes)))
    return pd.DataFrame({"a": nodes[moved].view(np.int64), "b": nodes[labels[moved]].view(np.int64)})


def _router(cuts: np.ndarray, ones: np.ndarray, masks: np.ndarray, max_bits: int, batches):
    """(block, fp, member) of every block a fingerprint belongs to or, from
    its own block on, may link into."""
    index = GrayIndex(ones, masks)
    for batch in batches:
        for i in range(0, batch.num_rows, 8192):
            fp = batch.column(0).slice(i, 8192).to_numpy(zero_copy_only=False)
            codes = fp.view(np.uint64)
            own = np.searchsorted(cuts, gray_rank(codes), side="right")
            for q, block in index.search(codes, max_bits):
                fits = block >= own[q]
                q, block = q[fits], block[fits]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.astype(np.int32)), pa.array(fp[q]), pa.array(block == own[q])],
                    names=["block", "fp", "member"])


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges (a, b) whose components are those of the link relation over the
    distinct fingerprints ``fps`` (column ``fp``); no more than one edge for
    each time a fingerprint was routed."""
    spark = fps.sparkSession
    ship_package(spark)
    n = fps.count()
    blocks = max(1, min(MAX_BLOCKS, -(-n // BLOCK)))
    rank = gray_rank_column(F.col("fp"))
    cuts: list[int] = []
    if blocks > 1:
        parts = F.array(*[F.lit(i / blocks) for i in range(1, blocks)])
        cuts = sorted(set(fps.select(F.percentile_approx(rank, parts, max(10_000, 20 * blocks))).first()[0]))
    edges = np.array(cuts, np.int64)

    def number(batches):
        for batch in batches:
            ranks = gray_rank(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            own = np.searchsorted(unsigned, ranks, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(own), batch.column(0)], names=["block", "fp"])

    unsigned = edges.view(np.uint64) ^ np.uint64(1 << 63)
    # At most MAX_BLOCKS rows: the bits all members share.
    summary = (fps.select("fp").mapInArrow(number, "block int, fp long").groupBy("block")
               .agg(F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("any")).collect())
    ones, masks = np.zeros(len(cuts) + 1, np.int64), np.zeros(len(cuts) + 1, np.int64)
    for r in summary:
        ones[r["block"]], masks[r["block"]] = r["ones"], ~(r["ones"] ^ r["any"])
    route = partial(_router, unsigned, ones.view(np.uint64), masks.view(np.uint64), max_bits)
    routed = stored(fps.select("fp").mapInArrow(route, "block int, fp long, member boolean"), "simhash-routed")
    sizes = routed.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(SLICE)).cast("int").alias("slices"))
    mine = F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    dealt = (routed.join(F.broadcast(sizes), "block")
             .select("block", "fp", "member", mine.alias("mine"),
                     F.explode(F.when(F.col("member"), F.sequence(F.lit(0), F.col("slices") - 1))
                                .otherwise(F.array(mine))).alias("slice"))
             .select("block", "slice", "fp", "member", (F.col("mine") == F.col("slice")).alias("asks")))
    return dealt.groupBy("block", "slice").applyInPandas(partial(_forest, max_bits), "a long, b long")


# -- groups ---------------------------------------------------------------

def groups(rows: DataFrame, id_col: str, max_bits: int = 2) -> DataFrame:
    """(fp, component_id, keeper) per distinct fingerprint of ``rows`` (stored;
    columns ``fp``, ``uid`` and the id): the smallest id of the group, and the
    ``uid`` of the row that has it (the smallest, among several)."""
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("uid")))
    fps = stored(rows.groupBy("fp").agg(first.alias("first")), "simhash-fps")
    roots = components(links(fps, max_bits))
    rooted = (fps.join(roots, fps["fp"] == roots["node"], "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    rooted = stored(rooted, "simhash-rooted")
    best = stored(rooted.groupBy("root").agg(F.min("first").alias("best")), "simhash-best")
    # Two stored tables: a large group's partition can be split.
    return rooted.join(best, "root").select("fp", F.col("best.id").alias("component_id"),
                                            F.col("best.uid").alias("keeper"))


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2, text: str = "text",
                    id_col: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all) plus ``fp``,
    ``component_id`` and ``is_kept`` (true for one row of each group)."""
    marked = fingerprints(docs, width, text, keep).withColumn("uid", F.monotonically_increasing_id())
    marked = stored(marked, "simhash-docs")
    found = groups(marked.select("fp", "uid", id_col), id_col, max_bits)
    return (marked.join(found, "fp").withColumn("is_kept", F.col("uid") == F.col("keeper"))
            .drop("uid", "keeper"))


def drop_near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2, text: str = "text",
                         id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group, same columns."""
    marked = stored(fingerprints(docs, width, text, name="_fp")
                    .withColumn("_uid", F.monotonically_increasing_id()), "simhash-docs")
    slim = marked.select(F.col("_fp").alias("fp"), F.col("_uid").alias("uid"), id_col)
    found = groups(slim, id_col, max_bits)
    extra = stored(slim.join(found, "fp").where("uid <> keeper").select(F.col("uid").alias("_uid")), "simhash-extra")
    if extra.count() <= BROADCAST_ROWS:
        extra = F.broadcast(extra)  # the texts stay where they are
    return marked.join(extra, "_uid", "left_anti").select(*[f"`{c}`" for c in docs.columns])
