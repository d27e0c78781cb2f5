"""Frequency ranking, cumulative-share cutoff, per-term domains.

Orders are total: count descending, then the key ascending (term for W1/W2,
domain for W3), so every result is reproducible.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.materialize import materialize
from .ordinal import with_ordinal

# Lists of N rows that meet in one task while a key's rows are limited.
FAN_IN = 32

# Up to this many terms tied at the boundary count are ordered by a
# single-task top-k; larger tie groups use the distributed ordinal.
BOUNDARY_TOPK_LIMIT = 2_000_000


def rank_by_count(counts: DataFrame, key: str = "term", n: str = "n",
                  name: str = "rank") -> DataFrame:
    """1-based rank by (n desc, key asc), computed without a global window."""
    return with_ordinal(counts, [F.desc(n), F.asc(key)], name)


def boundary(counts: DataFrame, share: float, n: str = "n"):
    """Where the running share of ``n`` (largest first) first reaches ``share``.

    Works on the histogram count -> number of keys with that count, whose
    size is bounded by the number of distinct counts (at most
    sqrt(2 * total)), so its running sum fits one small window.  Returns
    None (nothing kept) or (n_star, keep_at_n_star, keys_at_n_star).
    """
    hist = counts.groupBy(n).agg(F.count(F.lit(1)).alias("_c"))
    desc = Window.orderBy(F.desc(n))
    h = (hist.withColumn("_mass", F.col(n) * F.col("_c"))
             .withColumn("_before", F.coalesce(
                 F.sum("_mass").over(desc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("_total", F.sum("_mass").over(
                 desc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    row = (h.filter((F.col("_before") + F.col("_mass")) / F.col("_total") >= F.lit(float(share)))
            .orderBy(F.desc(n)).limit(1).collect())
    if not row:
        return None
    r = row[0]
    n_star, c, before, total = int(r[n]), int(r["_c"]), int(r["_before"]), int(r["_total"])

    def reached(j: int) -> bool:  # the same double comparison, row by row
        return (before + j * n_star) / total >= share

    j = max(1, min(c, math.ceil((share * total - before) / n_star)))
    while j > 1 and reached(j - 1):
        j -= 1
    while j < c and not reached(j):
        j += 1
    return n_star, j, c


def share_cutoff(counts: DataFrame, share: float, key: str = "term",
                 n: str = "n") -> DataFrame:
    """Keep rows in (n desc, key asc) order up to and including the
    first one whose running sum / total >= share.

    share > 1 (never reached) or empty input -> empty; share <= 0 -> one row.
    Rows above the boundary count are a plain filter; only the tie group at
    the boundary count is ordered by key.
    """
    b = boundary(counts, share, n)
    if b is None:
        return counts.filter(F.lit(False))
    n_star, keep, tied = b
    above = counts.filter(F.col(n) > n_star)
    at = counts.filter(F.col(n) == n_star)
    if keep < tied:
        if tied <= BOUNDARY_TOPK_LIMIT:
            at = at.orderBy(F.asc(key)).limit(keep)
        else:
            at = (with_ordinal(at, [F.asc(key)], "_o")
                  .filter(F.col("_o") <= keep).drop("_o"))
    return above.unionByName(at)


def merge_levels(rows: int, most: int, fan_in: int = FAN_IN) -> list[int]:
    """Numbers of parts in which a key of ``rows`` rows is limited, level by
    level, so that about fan_in * most rows meet in each; the last is 1."""
    levels, parts = [], -(-rows // max(1, fan_in * most))
    while parts > 1:
        levels.append(parts)
        parts = -(-parts // fan_in)
    return [*levels, 1]


def _largest(pairs: DataFrame, key: str, enough: int) -> int:
    """Rows of the most frequent key of a stored table, or of the whole table
    if that is small."""
    rows = pairs.count()
    if rows > enough:
        rows = pairs.groupBy(key).count().agg(F.max("count")).first()[0]
    return rows


def _limited(td: DataFrame, order, key: str, item: str, most: int, pairs: DataFrame | None) -> DataFrame:
    """The first ``most`` rows of each key in ``order``, with their ``rank``.

    A key's rows are limited in parts first, the lists that are left in fewer
    parts, and so on: no task gets the lists of all tasks before it."""
    if pairs is None:
        td = pairs = materialize(td, "ranked-pairs")
    out, at = td, F.xxhash64(item)
    for parts in merge_levels(_largest(pairs, key, FAN_IN * most), most):
        at = F.pmod(at, F.lit(parts))
        by = Window.partitionBy(key, *([at] if parts > 1 else [])).orderBy(*order)
        out = out.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= most)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


def top_domains(td: DataFrame, max_domains: int, key: str = "term", item: str = "domain", n: str = "n",
                pairs: DataFrame | None = None) -> DataFrame:
    """The ``max_domains`` most frequent items per key (ties: item asc).

    ``row_number() <= N`` lets Spark put a partial group limit before each
    shuffle.  ``pairs``: a stored table with at least these keys' rows, from
    which the number of levels follows; without it ``td`` is stored."""
    return _limited(td, [F.desc(n), F.asc(item)], key, item, max_domains, pairs)


def first_seen_rank(td: DataFrame, max_domains: int, first: str = "first_seen", key: str = "term",
                    item: str = "domain", pairs: DataFrame | None = None) -> DataFrame:
    """Per key, the first ``max_domains`` distinct items met, ranked by
    the position (``first``) where each pair was first seen."""
    return _limited(td, [F.asc(first), F.asc(item)], key, item, max_domains, pairs)


def first_seen_domains(occ: DataFrame, max_domains: int, order: str = "ord",
                       key: str = "term", item: str = "domain") -> DataFrame:
    """W4 from raw occurrences (key, item, order)."""
    first = occ.groupBy(key, item).agg(F.min(order).alias("first_seen"))
    return first_seen_rank(first, max_domains, "first_seen", key, item)


def domain_lists(ranked: DataFrame, key: str = "term", item: str = "domain",
                 name: str = "domains") -> DataFrame:
    """Comma-joined items in rank order (at most N per key)."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col("rank"), F.col(item))))
    return ranked.groupBy(key).agg(
        F.array_join(F.transform(pairs, lambda s: s[item]), ",").alias(name))


def sorted_terms(td: DataFrame, key: str = "term") -> DataFrame:
    """Distinct keys, ascending (range-partitioned sort)."""
    return td.select(key).distinct().orderBy(key)


def restrict_to(td: DataFrame, kept: DataFrame, key: str = "term") -> DataFrame:
    """Rows of ``td`` whose key is in ``kept`` (left semi join)."""
    return td.join(kept.select(key), key, "left_semi")
