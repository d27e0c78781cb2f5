"""Host -> registered domain (public suffix + one label).

For each suffix depth k = 1..max_depth the last k labels of the host are
looked up among the rules of that depth.  A rule set is small and its size
is checked when loaded (``sources.suffixes``): up to INLINE_RULES_LIMIT keys
the lookups are hash-set membership tests inside the generated code; a
larger list is probed with one broadcast hash join per depth.  Either way
rows are never shuffled, and the operator works on streams as well.

Suffix length L:
  * an exception rule "!key" at depth k gives k-1 and wins over all others;
  * otherwise the longest of: plain rule at k -> k; wildcard "*.key" at k
    -> k+1 when the host has more than k labels;
  * no match -> 0 (unlisted TLD, IP address, "localhost").
The registered domain is the last L+1 labels, or null when L = 0, the host
has no label left, or that label is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import lenient_host
from ..sources.suffixes import SuffixRules


def _greatest(cols: list[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


# Rule sets up to this many keys are tested with hash-set membership
# (Spark's InSet) inside one expression; larger ones with one broadcast hash
# join per depth.
INLINE_RULES_LIMIT = 20000


def _depth_flags(rules: SuffixRules, k: int):
    keys = [r for r in rules.rows if r[4] == k]
    return ([r[0] for r in keys if r[1]], [r[0] for r in keys if r[2]],
            [r[0] for r in keys if r[3]])


def _member(col: str, values: list[str]) -> Column:
    """Whether ``col`` is one of ``values``: an expression given as text, which
    the driver builds in one step (a Column for each value takes seconds)."""
    if not values:
        return F.lit(False)
    texts = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return F.expr(f"`{col}` IN ({texts})")


def _suffix_length(flags) -> Column:
    """Suffix length L from per-depth (plain, wild, exc, n) flags."""
    excs, others = [], []
    for k, (kp, kw, kx, n) in enumerate(flags, start=1):
        excs.append(F.when(kx, F.lit(k - 1)))
        others.append(F.when(kp, F.lit(k)))
        others.append(F.when(kw & (n > k), F.lit(k + 1)))
    return F.coalesce(_greatest(excs), _greatest(others), F.lit(0))


def _domain_of(h: Column, L: Column) -> Column:
    """Last L+1 labels of h, or null when nothing is registered."""
    labels = F.split(h, r"\.")
    n = F.size(labels)
    label = F.try_element_at(labels, -(L + 1))
    ok = (L >= 1) & (n >= L + 1) & (label != "")
    return F.when(ok, F.array_join(F.slice(labels, -(L + 1), L + 1), "."))


def with_registered_domain(df: DataFrame, host: Column, rules: SuffixRules,
                           out: str = "domain") -> DataFrame:
    """Add column ``out``: registered domain of the (already lenient) host.

    Helper columns are added step by step; each step reads the previous
    ones several times, so the optimizer keeps them as separate
    projections instead of copying the long host expression into every use.
    Callers should not filter on ``out`` directly (a pushed-down filter
    would copy the whole expression); see ``present``.
    """
    if rules.max_depth == 0:  # empty rule set: nothing is registered
        return df.withColumn(out, F.lit(None).cast("string"))
    h, n, L = "_rd_h", "_rd_n", "_rd_len"
    depths = range(1, rules.max_depth + 1)
    df = df.withColumn(h, host)
    df = df.withColumns({n: F.size(F.split(F.col(h), r"\.")),
                         **{f"_rk{k}": F.substring_index(F.col(h), ".", -k) for k in depths}})
    helper = [f"_rk{k}" for k in depths]
    flags = []
    if rules.local and rules.n_keys <= INLINE_RULES_LIMIT:
        for k in depths:
            plain, wild, exc = _depth_flags(rules, k)
            flags.append((*[(F.col(n) >= k) & _member(f"_rk{k}", v) for v in (plain, wild, exc)], F.col(n)))
    else:
        spark = df.sparkSession
        for k in depths:
            kk, p, w, x = f"_rj{k}", f"_rp{k}", f"_rw{k}", f"_rx{k}"
            side = rules.at_depth(spark, k).select(
                F.col("key").alias(kk), F.col("plain").alias(p),
                F.col("wild").alias(w), F.col("exc").alias(x))
            if rules.local:            # size checked on load
                side = F.broadcast(side)
            probe = F.when(F.col(n) >= k, F.col(f"_rk{k}"))
            df = df.join(side, probe == F.col(kk), "left")
            flags.append((F.col(p), F.col(w), F.col(x), F.col(n)))
            helper += [kk, p, w, x]
    df = df.withColumn(L, _suffix_length(flags))
    return df.withColumn(out, _domain_of(F.col(h), F.col(L))).drop(h, n, L, *helper)


def registered_domain(df: DataFrame, text_col: str, rules: SuffixRules,
                      out: str = "domain", stripped: bool = False) -> DataFrame:
    """P3 on a URL or bare-host column (lenient host reading first)."""
    return with_registered_domain(df, lenient_host(F.col(text_col), stripped), rules, out)


def present(col: str, *values: str) -> Column:
    """Generator keeping rows where ``col`` is not null.

    ``df.select(..., F.inline(present("domain", "domain", "url")))`` emits
    the listed columns for rows with a domain.  Unlike a filter, which
    Catalyst pushes below the projection by copying the (long) domain
    expression into it, a generator input is evaluated once.
    """
    fields = [F.col(v).alias(v) for v in (values or (col,))]
    return F.when(F.col(col).isNotNull(), F.array(F.struct(*fields)))


def registered_only(df: DataFrame, text_col: str, rules: SuffixRules,
                    keep: tuple[str, ...] = (), out: str = "domain",
                    stripped: bool = False) -> DataFrame:
    """(keep..., out) for rows whose text has a registered domain."""
    d = registered_domain(df.select(*keep, text_col), text_col, rules, out, stripped)
    return d.select(F.inline(present(out, *keep, out)))
