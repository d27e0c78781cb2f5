"""How the sources of a language differ in their words.

Term frequencies by single-pass in-memory indexing.  A task reads its
documents once and adds their terms to the postings of a block (term -> source
-> count, and the number of documents).  When the block has BLOCK_POSTINGS
postings it is spilled as a run: for each shard (a hash of the term) and
language one row with the terms in order and their postings packed in columns.
Spark deals the rows by shard; a task merges a shard's runs through a heap,
so a term's postings come together whatever block they are from, and keeps the
terms that enough documents hold.  Only blocks and packed runs are ever in
memory, and a frequent term or source has one posting a run, not a row a use.

Divergences.  With add-two smoothing p = 1 + floor(10^9 (n + 2) / (N + 2 V)),
two groups differ at a term by floor((p - q)^2 / (p + q)).  Most terms are
absent from most groups, so a pair's sum starts from what it would be if no
term occurred in both; each group's histogram of counts gives the terms that
one side has alone, and the terms that both have are streamed by, each adding
the correction of its pairs to a table of sums that a task flushes when it has
PAIR_SUMS entries.

Defined results: null text, language and source read as ''; a language without
kept terms has V = 0 and divergences 0; repeated rows are documents of their
own; an empty table gives an empty table; columns other than those named are
not read.  All arithmetic is on integers.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import SLICE_ROWS, stored

MIN_DOCS = 10
#: Postings a block holds before it is spilled.
BLOCK_POSTINGS = 1 << 19
#: Documents a shard stands for.
SHARD_DOCS = 8192
MAX_SHARDS = 100_000
PAIR_SUMS = 1 << 20
TOP_TERMS = 10
#: Fixed by the definition of p.
UNIT, SMOOTH = 1_000_000_000, 2

#: Bytes of terms stay (A-Z lower-cased), all others become spaces.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Terms ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` in UTF-8, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


class Block:
    """Postings of one language."""

    def __init__(self):
        self.docs: Counter = Counter()
        self.counts: dict[str, Counter] = {}

    def add(self, source: str, words: list[bytes]) -> None:
        self.docs.update(set(words))
        if source not in self.counts:
            self.counts[source] = Counter()
        self.counts[source].update(words)

    def __len__(self) -> int:
        return sum(map(len, self.counts.values()))

    def run(self, shards: int):
        """(shard, packed columns): the block's terms in order, by shard."""
        order = sorted(self.docs)
        at = {t: i for i, t in enumerate(order)}
        shard = np.fromiter((zlib.crc32(t) % shards for t in order), np.int32, len(order))
        docs = np.fromiter(map(self.docs.__getitem__, order), np.int64, len(order))
        names = sorted(self.counts)
        term = np.concatenate([np.fromiter(map(at.__getitem__, c), np.int64, len(c))
                               for c in map(self.counts.get, names)])
        count = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in map(self.counts.get, names)])
        source = np.repeat(np.arange(len(names)), [len(self.counts[s]) for s in names])
        by_term = np.argsort(term, kind="stable")
        term, count, source = term[by_term], count[by_term], source[by_term]
        whose = shard[term]
        for s in np.unique(shard).tolist():
            mine, posts = np.flatnonzero(shard == s), whose == s
            sizes = np.bincount(term[posts], minlength=len(order))[mine]
            yield s, (b"\n".join(order[i] for i in mine.tolist()), docs[mine].astype("<i8").tobytes(),
                      sizes.astype("<i4").tobytes(), source[posts].astype("<i4").tobytes(),
                      count[posts].astype("<i8").tobytes(), names)


RUN = "shard int, lang string, terms binary, docs binary, sizes binary, sources binary, counts binary, " \
      "names array<string>"


def _indexer(shards: int, limit: int, batches):
    blocks: dict[str, Block] = {}

    def spill():
        for lang, block in blocks.items():
            for s, packed in block.run(shards):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), pa.array([lang]), *[pa.array([x], pa.binary()) for x in packed[:5]],
                     pa.array([packed[5]], pa.list_(pa.string()))],
                    names=[c.split(" ")[0] for c in RUN.split(", ")])
        blocks.clear()

    for batch in batches:
        for i in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(i, SLICE_ROWS)
            for lang, source, text in zip(*(c.to_pylist() for c in part.columns)):
                words = terms(text)
                if words:
                    blocks.setdefault(lang, Block()).add(source, words)
            if sum(map(len, blocks.values())) >= limit:
                yield from spill()
    yield from spill()


class Run:
    """One packed run, read term by term."""

    def __init__(self, row: dict):
        self.terms = row["terms"].split(b"\n")
        self.docs = np.frombuffer(row["docs"], "<i8").tolist()
        self.ends = np.cumsum(np.frombuffer(row["sizes"], "<i4"), dtype=np.int64).tolist()
        self.sources, self.counts = np.frombuffer(row["sources"], "<i4"), np.frombuffer(row["counts"], "<i8")
        self.names = row["names"]

    def heads(self, number: int):
        return zip(self.terms, [number] * len(self.terms), range(len(self.terms)))

    def postings(self, i: int):
        a, b = self.ends[i - 1] if i else 0, self.ends[i]
        return zip(map(self.names.__getitem__, self.sources[a:b].tolist()), self.counts[a:b].tolist())


def merge_runs(runs: list[Run], least: int):
    """(term, {source: count}) of terms in at least ``least`` documents, in
    order, from term-sorted runs, by a heap over their heads."""
    now, held, docs = None, [], 0

    def whole():
        counts: dict[str, int] = {}
        for r, i in held:
            for s, n in runs[r].postings(i):
                counts[s] = counts.get(s, 0) + n
        return now, counts

    for term, r, i in heapq.merge(*(run.heads(k) for k, run in enumerate(runs))):
        if term != now:
            if docs >= least:
                yield whole()
            now, held, docs = term, [], 0
        held.append((r, i))
        docs += runs[r].docs[i]
    if docs >= least:
        yield whole()


def _merger(least: int, batches):
    key, runs = None, []

    def done():
        rows: list[tuple] = []
        for term, counts in merge_runs(runs, least):
            names = sorted(counts)
            rows.append((key[1], term.decode("utf-8", "surrogatepass"), sum(counts.values()), names,
                         [counts[s] for s in names]))
            if len(rows) >= 4096:
                yield packed(rows)
                rows = []
        if rows:
            yield packed(rows)

    def packed(rows):
        kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)],
                                          names=["lang", "term", "total", "sources", "counts"])

    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if (row["shard"], row["lang"]) != key:
                if runs:
                    yield from done()
                key, runs = (row["shard"], row["lang"]), []
            runs.append(Run(row))
    if runs:
        yield from done()


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, block: int = BLOCK_POSTINGS,
                shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(lang, term, total, sources, counts) of the kept terms of ``docs``
    (lang, source, text; no nulls in the first two): the sources that use a
    term, in order, and how often each does."""
    ship_package(docs.sparkSession)
    shards = min(MAX_SHARDS, max(1, -(-docs.count() // shard_docs)))
    runs = docs.select("lang", "source", "text").mapInArrow(partial(_indexer, shards, block), RUN)
    together = runs.repartition(shards, "shard").sortWithinPartitions("shard", "lang")
    return together.mapInArrow(partial(_merger, min_docs),
                               "lang string, term string, total long, sources array<string>, counts array<long>")


def chance(n: Column, size: Column, kept: Column) -> Column:
    """1 + floor(UNIT (n + 2) / (N + 2 V)), exactly; 1 where V is 0."""
    up = F.lit(UNIT).cast("decimal(10,0)") * (n + SMOOTH).cast("decimal(20,0)")
    down = F.greatest(size + SMOOTH * kept, F.lit(1)).cast("decimal(20,0)")
    return F.call_function("div", up, down) + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _streamer(limit: int, batches):
    """(lang, a, b, sum): corrections of the terms that groups a < b share."""
    sums: dict[tuple[str, int, int], int] = {}

    def flush():
        if not sums:
            return
        keys = list(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
             pa.array([k[2] for k in keys], pa.int64()), pa.array(list(sums.values()), pa.int64())],
            names=["lang", "a", "b", "sum"])
        sums.clear()

    def add(lang, a, b, value):
        """Sum by pair, then into the table."""
        order = np.lexsort((b, a))
        a, b, value = a[order], b[order], value[order]
        starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        for x, y, v in zip(a[starts].tolist(), b[starts].tolist(), np.add.reduceat(value, starts).tolist()):
            sums[lang, x, y] = sums.get((lang, x, y), 0) + v

    for batch in batches:
        langs = np.asarray(batch.column(0).to_pylist(), object)
        group, p, p0 = (batch.column(i) for i in (1, 2, 3))
        sizes = np.diff(group.offsets.to_numpy())
        starts = group.offsets.to_numpy()[:-1] - group.offsets[0].as_py()
        flat = [x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (group, p, p0)]
        for lang in dict.fromkeys(langs.tolist()):
            mine = langs == lang
            for k in np.unique(sizes[mine]).tolist():
                if k < 2:
                    continue
                rows = starts[mine & (sizes == k)]
                left, right = np.triu_indices(k, 1)
                step = max(1, (1 << 18) // len(left))
                for i in range(0, len(rows), step):
                    at = rows[i:i + step, None] + np.arange(k)
                    g, x, x0 = (c[at] for c in flat)
                    one, two = (left, right)
                    value = (_gaps(x[:, one], x[:, two]) - _gaps(x[:, one], x0[:, two])
                             - _gaps(x0[:, one], x[:, two]) + _gaps(x0[:, one], x0[:, two]))
                    add(lang, g[:, one].ravel(), g[:, two].ravel(), value.ravel())
                    if len(sums) >= limit:
                        yield from flush()
    yield from flush()


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, text: str = "text",
               lang: str = "lang", source: str = "source", block: int = BLOCK_POSTINGS,
               shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has every other
    source of the language by divergence, part ``term`` the ``top`` terms that
    the source uses more than its language does."""
    none = F.lit("")
    src = docs.select(F.coalesce(F.col(lang), none).alias("lang"), F.coalesce(F.col(source), none).alias("source"),
                      F.col(text).alias("text"))
    freq = stored(frequencies(src, min_docs, block, shard_docs), "divergence-terms")
    posts = (freq.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
             .select("lang", "term", "total", F.col("x.sources").alias("source"), F.col("x.counts").alias("n")))
    kept = freq.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_size"))
    sizes = posts.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    zero = F.lit(0).cast("long")
    groups = (src.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(kept, "lang", "left")
              .select("lang", "source", F.coalesce("size", zero).alias("size"), F.coalesce("kept", zero).alias("kept"),
                      F.coalesce("lang_size", zero).alias("lang_size"))
              .withColumn("p0", chance(zero, F.col("size"), F.col("kept")))
              .withColumn("id", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")))
    groups = stored(groups, "divergence-groups")
    rated = (posts.join(groups, ["lang", "source"])
             .withColumn("p", chance(F.col("n"), F.col("size"), F.col("kept"))))
    # Part term.
    q = chance(F.col("total"), F.col("lang_size"), F.col("kept"))
    over = (rated.withColumn("q", q).where("n > 0 AND p > q")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    gap(F.col("p"), F.col("q")).alias("value")))
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = over.withColumn("rank", ranked).where(F.col("rank") <= top)
    # Part pair: what groups a < b would have without common terms, then the corrections.
    a = groups.select("lang", F.col("id").alias("a"), F.col("source").alias("a_source"), F.col("p0").alias("a_p0"),
                      "kept")
    b = groups.select("lang", F.col("id").alias("b"), F.col("source").alias("b_source"), F.col("p0").alias("b_p0"))
    pairs = a.join(b, "lang").where("a <> b")
    start = pairs.where("a < b").select("lang", "a", "b", (F.col("kept") * gap(F.col("a_p0"), F.col("b_p0"))).alias("sum"))
    hist = rated.groupBy("lang", F.col("id").alias("a"), F.col("p0").alias("a_p0"), "p").agg(
        F.count(F.lit(1)).alias("times"))
    alone = F.col("times") * (gap(F.col("p"), F.col("b_p0")) - gap(F.col("a_p0"), F.col("b_p0")))
    one_sided = (hist.join(b, "lang").where("a <> b")
                 .select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), alone.alias("sum")))
    shared = (rated.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("id", "p", "p0"))).alias("x"))
              .where(F.size("x") > 1)
              .select("lang", F.col("x.id").alias("ids"), F.col("x.p").alias("p"), F.col("x.p0").alias("p0")))
    both = shared.mapInArrow(partial(_streamer, PAIR_SUMS), "lang string, a long, b long, sum long")
    total = start.unionByName(one_sided).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("sum").alias("value"))
    named = (pairs.select("lang", "a_source", "b_source", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
             .join(total, ["lang", "a", "b"])
             .select("lang", F.col("a_source").alias("source"), F.lit("pair").alias("part"),
                     F.col("b_source").alias("item"), "value"))
    return (named.withColumn("rank", ranked).unionByName(best)
            .select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"),
                    F.col("rank").cast("int").alias("rank")))
