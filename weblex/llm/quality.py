"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger stores the
measurements the rules read and one bit per failed rule; a policy is a
versioned pair of masks over those bits, so changing a policy, comparing
versions or asking what one rule costs never touches the texts again.
Ablations first count documents per distinct bit pattern (a map-side
combined aggregate of at most 2^rules rows), then work on those counts.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined results: a null text has no words
and fails ``few_words``; an empty text likewise; repeated rows are judged row
by row; an empty table gives an empty ledger; other columns pass through,
those named like a ledger column give way to it.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, field

WINDOW = 8
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
            "n_repeat_words", "n_upper", "n_letters"]

#: Rule of bit i: (name, SQL condition on the measurements that fails it).
RULES = [
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("symbols", "5 * n_symbols > 2 * n_words"),
    ("short_or_long_words", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    ("capitals", "10 * n_upper > 7 * n_letters"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """Reject a document that fails any rule of ``hard``, or ``soft_limit``
    or more of the rules of ``soft``."""

    version: str
    hard: int
    soft: int = 0
    soft_limit: int = 1

    def rejects(self, bits: Column) -> Column:
        hard = bits.bitwiseAND(F.lit(self.hard).cast("bigint")) != 0
        soft = F.bit_count(bits.bitwiseAND(F.lit(self.soft).cast("bigint"))) >= self.soft_limit
        return (hard | soft) if self.soft else hard


BASE = BIT["few_words"] | BIT["repeated_words"]
#: Policies by version; a version is never changed once used.
POLICIES = {
    "base-1": Policy("base-1", BASE),
    "web-1": Policy("web-1", BASE | BIT["symbols"] | BIT["capitals"],
                    BIT["duplicate_lines"] | BIT["short_or_long_words"], 2),
}
DEFAULT_POLICY = "web-1"


def _mixed(ids: np.ndarray) -> np.ndarray:
    x = ids * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a ``window``-word run found twice or more.

    Runs are compared by a 64-bit sum first; only runs whose sums agree are
    compared word by word, so the result is exact."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    vocab: dict[bytes, int] = {}
    ids = np.fromiter((vocab.setdefault(w, len(vocab)) for w in words), np.uint64, len(words))
    if len(vocab) == len(words):
        return 0
    x = _mixed(ids)
    sums = x[:n].copy()
    for j in range(1, window):
        sums = sums * np.uint64(0x100000001B3) + x[j:j + n]
    order = np.argsort(sums, kind="stable")
    same = sums[order[1:]] == sums[order[:-1]]
    if not same.any():
        return 0
    maybe = np.zeros(n, bool)
    maybe[order[1:][same]] = True
    maybe[order[:-1][same]] = True
    starts = np.flatnonzero(maybe).tolist()
    runs = {i: tuple(ids[i:i + window].tolist()) for i in starts}
    seen = Counter(runs.values())
    edge = np.zeros(len(words) + 1, np.int64)
    for i, run in runs.items():
        if seen[run] > 1:
            edge[i] += 1
            edge[i + window] -= 1
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    if not text:
        return (0,) * len(MEASURES)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    upper = len(data) - len(data.translate(None, UPPER))
    lower = len(data) - len(data.translate(None, LOWER))
    return (len(words), len(text) - sum(map(text.count, SPACES)),
            len(data) - len(data.translate(None, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)),
            repeated_words(words), upper, upper + lower)


def _measurer():
    return lambda texts: list(zip(*map(measure, texts))) or [[]] * len(MEASURES)


def ledger(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` plus the measurements (long) and ``fail_bits`` (long)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != "fail_bits"]
    measured = annotate(docs, _measurer, [field(m, T.LongType()) for m in MEASURES], text, keep)
    bits = None
    for name, fails in RULES:
        bit = F.when(F.expr(fails), F.lit(BIT[name])).otherwise(F.lit(0)).cast("bigint")
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return measured.withColumn("fail_bits", bits)


def freed_bits(bits: Column, policy: Policy) -> Column:
    """The rules that alone stand between a document and the policy: switching
    off any one of them would keep it."""
    out = F.lit(0).cast("bigint")
    for bit in BIT.values():
        without = bits.bitwiseAND(F.lit(~bit).cast("bigint"))
        freed = policy.rejects(bits) & ~policy.rejects(without)
        out = out.bitwiseOR(F.when(freed, F.lit(bit).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return out


def judge(led: DataFrame, version: str = DEFAULT_POLICY) -> DataFrame:
    """The ledger plus ``base_failed``, ``kept`` and ``freed_bits`` under a
    policy."""
    base = F.col("fail_bits").bitwiseAND(F.lit(BASE).cast("bigint")) != 0
    policy = POLICIES[version]
    return (led.withColumn("base_failed", base)
               .withColumn("kept", ~base & ~policy.rejects(F.col("fail_bits")))
               .withColumn("freed_bits", freed_bits(F.col("fail_bits"), policy)))


def ablations(led: DataFrame, version: str = DEFAULT_POLICY) -> DataFrame:
    """Per rule: documents failing it, and documents the policy would keep
    more if that rule alone were switched off.  One row per rule."""
    patterns = led.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("bigint").alias("bit"))
                                for n, b in BIT.items()])).alias("r")
    per = patterns.select("n", "fail_bits", freed_bits(F.col("fail_bits"), POLICIES[version]).alias("freed"), rules)

    def having(bits: str) -> Column:
        return F.sum(F.when(F.col(bits).bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0))

    return per.groupBy(F.col("r.rule").alias("rule")).agg(having("fail_bits").alias("n_failed"),
                                                          having("freed").alias("n_freed"))
