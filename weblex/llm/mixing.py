"""Mixing sources to target weights by soft memberships.

A naive Bayes classifier over hashed words, counted from a bounded sample of
labelled rows, gives each document a posterior over the domains (tempered:
the mean evidence of a word times SHARPNESS).  Document rates are the
nonnegative least-squares fit of expected domain token totals to the targets:

    minimise  (T - t)' M (T - t),   T_d = sum_i r_i n_i p_id,   low <= r_i <= high

by accelerated projected gradient from r = 1, in the metric weighted by
document tokens.  M is the inverse of the domains' Gram matrix, sum n p p': it
weighs the domains so that the step size is one and rare domains do not slow
the fit.  An iteration is one aggregation over the stored posteriors: every
rate, and its extrapolation, is a function of the document's posterior and of
the steps so far, r <- clip(y - p . s), which tasks replay; no rate is ever
gathered.  Steps restart when the objective rises.

With a budget the targets are its shares and rates may fall to 0.  Without
one documents are only repeated (low = 1) and the total is free: it starts
from what the most abundant domain needs and grows where the fit stalls since
rates stand at 1.  No rate exceeds ``most_copies``.  The best rates met within
MAX_PASSES are used; what they reach is in the result (``gap``, the largest
relative gap of a share or, with a budget, of a total, and ``shares``), and
targets not met are reported by a warning, too.  A document is written
floor(rate) times, and once more with the rest as probability, decided by a
hash.

Defined results: a token is a word ``[^\\x20\\x09-\\x0D]+``; null and empty texts
have no tokens and keep rate 1; labels outside the targets are not used; a
domain without labelled words, or that no document belongs to, gets no
posterior and is left out of the fit; repeated rows each count; an empty table
gives an empty table; without any labelled word all posteriors are equal and
all rates 1; columns named like a result give way.
"""

from __future__ import annotations

import warnings
import zlib
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import annotate, field, release, stored

BUCKETS = 1 << 14
#: Most labelled rows read, those whose hashed ids come first.
LABELLED = 10_000
SHARPNESS = 8.0
#: Largest relative gap between a domain's share and its target.
TOLERANCE = 1e-3
#: Passes over the rows; a gap left after them is reported.
MAX_PASSES = 60
#: Most copies of a document.
MOST_COPIES = 1000.0
#: Passes in which the objective must halve, and in which the gap must shrink.
PATIENCE, LAST_PATIENCE = 3, 15
#: How far beyond what abundant domains now need the total grows.
GROWTH = 1.5
MEMO_ENTRIES = 300_000


def _bucket(word: bytes) -> int:
    return zlib.crc32(word) % BUCKETS


def _ids(text: str | None, memo: dict) -> list[int]:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(memo) > MEMO_ENTRIES:
        memo.clear()
    for w in words:
        if w not in memo:
            memo[w] = _bucket(w)
    return [memo[w] for w in words]


def labelled_sample(docs: DataFrame, labelled: DataFrame, id_col: str, most: int = LABELLED) -> DataFrame:
    """Rows (text, domain) of at most ``most`` labelled ids; ``labelled`` has
    the id and ``domain``.  The picked ids (a bounded table) are broadcast."""
    picked = (labelled.where(F.col("domain").isNotNull()).groupBy(id_col).agg(F.min("domain").alias("domain"))
              .orderBy(F.xxhash64(F.lit(23), F.col(id_col)), id_col).limit(most))
    return docs.select(id_col, "text").join(F.broadcast(picked), id_col).select("text", "domain")


def word_counts(sample: DataFrame, domains: list[str]) -> np.ndarray:
    """Words per (domain, bucket): counted in each task, summed by Spark into
    a table of at most len(domains) * BUCKETS rows."""
    at = {d: i for i, d in enumerate(domains)}
    ship_package(sample.sparkSession)

    def count(batches):
        total, memo = np.zeros((len(at), BUCKETS), np.int64), {}
        for batch in batches:
            for text, domain in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if domain in at:
                    total[at[domain]] += np.bincount(_ids(text, memo), minlength=BUCKETS)
        d, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(d.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[d, b])], names=["d", "b", "n"])

    rows = (sample.select("text", "domain").mapInArrow(count, "d int, b int, n long")
            .groupBy("d", "b").agg(F.sum("n").alias("n")).collect())
    out = np.zeros((len(domains), BUCKETS))
    for r in rows:
        out[r["d"], r["b"]] = r["n"]
    return out


def evidence(counts: np.ndarray) -> np.ndarray:
    """Log likelihood of a bucket in each domain, add-one smoothed; minus
    infinity for a domain without words."""
    smooth = counts + 1.0
    logs = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
    logs[counts.sum(axis=1) == 0] = -np.inf
    return logs


def _posteriors(logs: np.ndarray):
    memo: dict[bytes, int] = {}
    live = np.isfinite(logs).any(axis=1)
    logs = logs if live.any() else np.zeros_like(logs)
    flat = (live / live.sum() if live.any() else np.full(len(logs), 1.0 / len(logs))).tolist()
    by_bucket = np.ascontiguousarray(logs.T)

    def run(texts):
        counts, post = [], []
        for text in texts:
            ids = _ids(text, memo)
            counts.append(len(ids))
            if ids:
                z = SHARPNESS * by_bucket[ids].mean(axis=0, dtype=np.float64)
                e = np.exp(z - z.max())
                post.append((e / e.sum()).tolist())
            else:
                post.append(flat)
        return counts, post
    return run


def memberships(docs: DataFrame, logs: np.ndarray, text: str = "text", keep: list[str] | None = None,
                tokens: str = "n_tokens", posterior: str = "posterior") -> DataFrame:
    """``docs`` plus its number of tokens (long) and posterior (array)."""
    return annotate(docs, partial(_posteriors, logs),
                    [field(tokens, T.LongType()), field(posterior, T.ArrayType(T.DoubleType()))], text, keep)


@dataclass(frozen=True)
class Fit:
    """Rates as a rule: ``plan`` has (restart, momentum, step) of each iteration."""
    plan: tuple[tuple[bool, float, np.ndarray], ...]
    low: float
    high: float
    total: np.ndarray
    goal: np.ndarray
    gap: float
    passes: int

    def shares(self) -> np.ndarray:
        return self.total / max(self.total.sum(), 1e-300)


def replay(p: np.ndarray, plan, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """(rates, extrapolated rates) of documents with posteriors ``p``."""
    r = np.ones(len(p))
    y = r
    for restart, momentum, step in plan:
        new = np.clip((r if restart else y) - p @ step, low, high)
        y = new + momentum * (new - r)
        r = new
    return r, y


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, n)


def _totals(members: DataFrame, plan, low: float, high: float, n: int, tokens: str, posterior: str):
    """Domain totals for the rates and for the extrapolated ones, in one pass."""
    def add(batches):
        sums = np.zeros((2, n))
        for batch in batches:
            p = _matrix(batch.column(1), n)
            weights = batch.column(0).to_numpy(zero_copy_only=False)
            for i, x in enumerate(replay(p, plan, low, high)):
                sums[i] += (x * weights) @ p
        release()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(sums[0]), pa.array(sums[1])],
                                         names=["d", "r", "y"])

    rows = (members.select(F.coalesce(F.col(tokens), F.lit(0)).cast("long"), posterior)
            .mapInArrow(add, "d long, r double, y double").groupBy("d").agg(F.sum("r").alias("r"), F.sum("y").alias("y")))
    out = np.zeros((2, n))
    for x in rows.collect():
        out[0, x["d"]], out[1, x["d"]] = x["r"], x["y"]
    return out


def _gram(members: DataFrame, n: int, tokens: str, posterior: str) -> np.ndarray:
    """Sums of n p_a p_b."""
    p = [F.col(posterior)[d] for d in range(n)]
    pairs = [(a, b) for a in range(n) for b in range(a, n)]
    row = members.agg(*[F.sum(F.col(tokens) * p[a] * p[b]) for a, b in pairs]).first()
    gram = np.zeros((n, n))
    for (a, b), x in zip(pairs, row):
        gram[a, b] = gram[b, a] = x or 0.0
    return gram


def gaps(total: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """Relative gap of each domain; 0 for one left out of the fit."""
    return np.where(goal > 0, np.abs(total - goal) / np.where(goal > 0, goal, 1.0), 0.0)


def fit_rates(members: DataFrame, weights: dict[str, float], budget: float | None = None, tokens: str = "n_tokens",
              posterior: str = "posterior", most_copies: float = MOST_COPIES) -> Fit:
    """The rates of ``members``, which is read once an iteration: store it."""
    w = np.array(list(weights.values()), float)
    n = len(w)
    ship_package(members.sparkSession)
    gram = _gram(members, n, tokens, posterior)
    start = gram.sum(axis=1)
    low, high = (1.0, max(1.0, most_copies)) if budget is None else (0.0, most_copies)
    live = start > 1e-12 * start.sum()
    if not start.sum() or not w[live].sum():
        return Fit((), low, high, start, start, 0.0, 0)
    w = np.where(live, w, 0.0) / w[live].sum()
    wanted = live & (w > 0)
    size = budget or float((start[wanted] / w[wanted]).max())
    metric = np.linalg.inv(gram + 1e-9 * np.trace(gram) * np.eye(n))
    plan: list[tuple[bool, float, np.ndarray]] = []
    best, seen, before, inertia, since = None, [], np.inf, 1.0, 0
    for passes in range(1, MAX_PASSES + 1):
        total, ahead = _totals(members, plan, low, high, n, tokens, posterior)
        goal = size * w
        gap = float(gaps(total / total.sum(), w).max() if budget is None else gaps(total, goal).max())
        since = 0 if best is None or gap < 0.99 * best.gap else since + 1
        if best is None or gap < best.gap:
            best = Fit(tuple(plan), low, high, total, goal if budget else w * total.sum(), gap, passes)
        if gap < TOLERANCE or since >= LAST_PATIENCE:
            break
        value = float((total - goal) @ metric @ (total - goal))
        restart = value > before
        seen.append(value)
        before = value
        if len(seen) > PATIENCE and value > 0.5 * seen[-1 - PATIENCE]:
            need = float((total[wanted] / w[wanted]).max())
            if budget is None and need > size * (1 + 1e-9):
                size += GROWTH * (need - size)
                seen, before, restart = [], np.inf, True
            elif value > 0.98 * seen[-1 - PATIENCE]:
                break
        inertia = 1.0 if restart else inertia
        after = (1 + np.sqrt(1 + 4 * inertia * inertia)) / 2
        step = metric @ ((total if restart else ahead) - size * w)
        plan.append((restart, (inertia - 1) / after, step))
        inertia = after
    return best


def rate_column(fit: Fit, posterior: str = "posterior") -> Column:
    """The fitted rate of a document, by built-in functions."""
    if not fit.plan:
        return F.lit(1.0)
    steps = F.array(*[F.struct(F.lit(bool(restart)).alias("restart"), F.lit(float(momentum)).alias("momentum"),
                               F.array(*[F.lit(float(x)) for x in step]).alias("step"))
                      for restart, momentum, step in fit.plan])
    zero, low, high = F.lit(0.0), F.lit(float(fit.low)), F.lit(float(fit.high))

    def move(at: Column, one: Column) -> Column:
        along = F.aggregate(F.zip_with(F.col(posterior), one["step"], lambda p, s: p * s), zero, lambda a, x: a + x)
        return F.least(high, F.greatest(low, F.when(one["restart"], at["r"]).otherwise(at["y"]) - along))

    def step(at: Column, one: Column) -> Column:
        # The new rate is bound once, by a transform of one element.
        return F.transform(F.array(move(at, one)), lambda new: F.struct(
            new.alias("r"), (new + one["momentum"] * (new - at["r"])).alias("y")))[0]

    return F.aggregate(steps, F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("y")), step, lambda at: at["r"])


def copies_column(rate: Column, key: Column) -> Column:
    """floor(rate), plus one with the rest as probability, by a hash of ``key``."""
    unit = F.pmod(F.xxhash64(F.lit(41), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (unit < rate - F.floor(rate)).cast("bigint")).cast("int")


def report(domains: list[str], fit: Fit) -> None:
    """Warn of targets that are not met."""
    if fit.gap >= TOLERANCE:
        wanted = fit.goal / max(fit.goal.sum(), 1e-300)
        said = ", ".join(f"{d} {x:.4f} ({y:.4f})" for d, x, y in zip(domains, fit.shares(), wanted))
        warnings.warn(f"mixing: targets not met, largest relative gap {fit.gap:.2g}. Shares reached (wanted): {said}",
                      RuntimeWarning, stacklevel=3)


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float | None = None,
        id_col: str = "doc_id", text: str = "text", keep: list[str] | None = None,
        most: int = LABELLED, most_copies: float = MOST_COPIES) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all) plus ``n_tokens``,
    ``posterior`` (array, in the order of ``weights``), ``rate``, ``copies``,
    and of the whole mix ``gap`` and ``shares`` (array)."""
    domains = list(weights)
    counts = word_counts(labelled_sample(docs.select(id_col, F.col(text).alias("text")), labelled, id_col, most), domains)
    results = ("n_tokens", "posterior", "rate", "copies", "gap", "shares", "_row")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in results]
    members = memberships(docs, evidence(counts), text, keep).withColumn("_row", F.monotonically_increasing_id())
    members = stored(members, "mixing-members")
    live = {d: w for d, w, n in zip(domains, weights.values(), counts.sum(axis=1)) if n}
    fit = fit_rates(members, weights if live else dict.fromkeys(domains, 1.0), budget, most_copies=most_copies)
    report(domains, fit)
    rated = members.withColumn("rate", F.when(F.col("n_tokens") > 0, rate_column(fit)).otherwise(F.lit(1.0)))
    return (rated.withColumn("copies", copies_column(F.col("rate"), F.col("_row")))
            .withColumn("gap", F.lit(fit.gap)).withColumn("shares", F.array(*[F.lit(float(x)) for x in fit.shares()]))
            .drop("_row"))
