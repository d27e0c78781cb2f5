"""Public-suffix rules as a small Spark table.

Rules come either from a public suffix list file (any path Spark can read)
or from the ICANN section that the package holds.  They are merged to one row per suffix key
with three flags, which is what the registered-domain join probes:

    key    the suffix text ("co.uk"; the base of "*.ck" is "ck")
    plain  a plain rule "key" exists
    wild   a wildcard rule "*.key" exists
    exc    an exception rule "!key" exists
    depth  number of labels in key
"""

from __future__ import annotations

import pkgutil
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .lines import number_rows

# A public suffix list has ~10k rules; a rule set beyond this is no such list:
# it stays a table and is joined with a shuffle.
MAX_LOCAL_RULES = 50_000

ICANN_END_MARKER = "// ===END ICANN DOMAINS==="

#: The ICANN section of the public suffix list (publicsuffix.org, MPL-2.0), as
#: published, comments included.
ICANN_FILE = "data/icann_suffixes.dat"


@lru_cache(maxsize=1)
def icann_text() -> str:
    """The packaged list, whole (some 180 kB)."""
    return pkgutil.get_data(__package__.partition(".")[0], ICANN_FILE).decode("utf-8")


@lru_cache(maxsize=1)
def icann_rules() -> tuple[str, ...]:
    """Its rules in list order, in PSL syntax: "*." wildcard, "!" exception."""
    lines = (line.strip() for line in icann_text().splitlines())
    return tuple(line.split()[0].lower() for line in lines if line and not line.startswith("//"))


def ascii_form(rule: str) -> str | None:
    """Punycode (IDNA) spelling of a rule; None if it has none."""
    prefix = "*." if rule.startswith("*.") else "!" if rule.startswith("!") else ""
    try:
        return prefix + rule[len(prefix):].encode("idna").decode("ascii")
    except UnicodeError:
        return None


# Extra plain rules used with the driver's test pages, whose hosts all sit
# under these three names (so that sites stay apart, as a suffix library's
# extra_suffixes option would do).
FIXTURE_EXTRA_SUFFIXES = ["example.com", "example.net", "example.org"]


RULE_SCHEMA = "key string, plain boolean, wild boolean, exc boolean, depth int"


@dataclass(frozen=True)
class SuffixRules:
    """Merged rules, one row per key (key, plain, wild, exc, depth).

    A suffix list is small and its size is checked when it is loaded: it is
    then held as a driver-side tuple (``rows``), tested with hash sets or
    shipped as local relations to broadcast joins.  A rule set above
    MAX_LOCAL_RULES stays a distributed table (``table``), joined
    without a broadcast hint.
    """
    rows: tuple | None
    max_depth: int
    table: DataFrame | None = None
    size: int = 0

    @property
    def local(self) -> bool:
        return self.rows is not None

    @property
    def n_keys(self) -> int:
        return len(self.rows) if self.rows is not None else self.size

    def frame(self, spark: SparkSession) -> DataFrame:
        return local_frame(spark, list(self.rows)) if self.rows is not None else self.table

    def at_depth(self, spark: SparkSession, k: int) -> DataFrame:
        if self.rows is not None:
            return local_frame(spark, [r for r in self.rows if r[4] == k])
        return self.table.filter(F.col("depth") == k)


def local_frame(spark: SparkSession, rows: list) -> DataFrame:
    """Rules of one depth as a DataFrame (used by the broadcast-join path).

    With Arrow enabled (``build_session`` enables it) pandas input becomes
    a LocalRelation, whose broadcast runs no job; without it Spark builds
    the same rows from a Python RDD.
    """
    pdf = pd.DataFrame(rows, columns=["key", "plain", "wild", "exc", "depth"])
    return spark.createDataFrame(pdf, RULE_SCHEMA)


def local_strings(spark: SparkSession, values: list[str], name: str) -> DataFrame:
    """A short list as a table (at, name), numbered from 0."""
    return spark.createDataFrame(pd.DataFrame({"at": range(len(values)), name: values}), f"at int, {name} string")


def _split_rule(rule: str) -> tuple[str, str]:
    r = rule.strip().lower()
    if r.startswith("*."):
        return r[2:], "w"
    if r.startswith("!"):
        return r[1:], "x"
    return r, "n"


def merge_rule_list(rules) -> SuffixRules:
    """One row per key with plain / wildcard / exception flags."""
    flags: dict[str, list[bool]] = {}
    for rule in rules:
        key, kind = _split_rule(rule)
        if not key:
            continue
        f = flags.setdefault(key, [False, False, False])
        f["nwx".index(kind)] = True
    rows = tuple((k, f[0], f[1], f[2], k.count(".") + 1) for k, f in sorted(flags.items()))
    return SuffixRules(rows, max((r[4] for r in rows), default=0))


def merge_rule_frame(rules: DataFrame) -> DataFrame:
    """merge_rule_list on a distributed column ``rule`` (large rule sets)."""
    r = F.lower(F.trim(F.col("rule")))
    kind = (F.when(r.startswith("*."), F.lit("w")).when(r.startswith("!"), F.lit("x"))
             .otherwise(F.lit("n")))
    key = F.regexp_replace(r, r"^(?:[*][.]|!)", "")
    return (rules.select(key.alias("key"), kind.alias("kind"))
                 .filter(F.col("key") != "")
                 .groupBy("key")
                 .agg(F.max(F.col("kind") == "n").alias("plain"),
                      F.max(F.col("kind") == "w").alias("wild"),
                      F.max(F.col("kind") == "x").alias("exc"))
                 .withColumn("depth", F.size(F.split("key", r"\.")).cast("int")))


def rules_from_list(spark: SparkSession, rules: list[str]) -> SuffixRules:
    """Rules given as PSL strings (a short list that lives on the driver)."""
    return merge_rule_list(r for r in rules if r.strip())


@lru_cache(maxsize=4)
def _icann(extra: tuple[str, ...]) -> SuffixRules:
    rules = icann_rules()
    forms = [ascii_form(r) for r in rules if not r.isascii()]
    return merge_rule_list([*rules, *filter(None, forms), *extra])


def builtin_rules(spark: SparkSession, extra: list[str] | None = None) -> SuffixRules:
    """The packaged ICANN rules, in both spellings."""
    return _icann(tuple(extra or ()))


def fixture_rules(spark: SparkSession) -> SuffixRules:
    """Built-in rules plus the three example.* names of the test pages."""
    return builtin_rules(spark, FIXTURE_EXTRA_SUFFIXES)


def _ascii_forms(rules: DataFrame) -> DataFrame:
    """Punycode (IDNA) spelling of non-ASCII rules, so xn-- hosts match."""
    ship_package(rules.sparkSession)

    @F.pandas_udf("string")
    def to_ascii(s: pd.Series) -> pd.Series:
        return s.map(ascii_form)

    non_ascii = rules.filter(~F.col("rule").rlike(r"^[\x00-\x7f]*$"))
    return (non_ascii.select(to_ascii(F.col("rule")).alias("rule"))
                     .filter(F.col("rule").isNotNull()))


def read_rule_lines(spark: SparkSession, path: str, private: bool = False) -> DataFrame:
    """The rules (column ``rule``) of public suffix list files, line by line.

    A rule is a line's first word; comments and blank lines are none.  Rules
    under a file's end-of-ICANN marker are private and kept on request only:
    lines are numbered by split, so files of any size are read in parallel."""
    raw = spark.read.text(path).select(
        F.trim(F.col("value")).alias("line"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"))
    if private:
        lines = raw
    else:
        numbered = number_rows(raw)
        ends = numbered.filter(F.col("line") == ICANN_END_MARKER).groupBy("file").agg(F.min("line_no").alias("end"))
        lines = (numbered.join(ends, "file", "left")
                 .filter(F.col("end").isNull() | (F.col("line_no") < F.col("end"))))
    return (lines.filter((F.col("line") != "") & ~F.col("line").startswith("//"))
            .select(F.split(F.col("line"), r"\s+").getItem(0).alias("rule")))


def read_suffix_rules(spark: SparkSession, path: str, private: bool = False,
                      extra: list[str] | None = None, idna: bool = True) -> SuffixRules:
    """Rules of public suffix list files (any path Spark reads).

    Spark reads, merges and stores them, one row per key.  The stored rows
    are counted before they are brought to the driver; a rule set over
    MAX_LOCAL_RULES is joined as a distributed table instead.
    """
    from ..plans.materialize import materialize

    rules = read_rule_lines(spark, path, private)
    if idna:
        rules = rules.unionByName(_ascii_forms(rules))
    if extra:
        rules = rules.unionByName(spark.createDataFrame([(e,) for e in extra], "rule string"))
    table = materialize(merge_rule_frame(rules), "suffix-rules")
    stats = table.agg(F.max("depth").alias("d"), F.count(F.lit(1)).alias("n")).first()
    if stats["n"] > MAX_LOCAL_RULES:
        return SuffixRules(None, int(stats["d"]), table, int(stats["n"]))
    rows = table.select("key", "plain", "wild", "exc", "depth").orderBy("key").collect()
    return SuffixRules(tuple(map(tuple, rows)), int(stats["d"] or 0))
