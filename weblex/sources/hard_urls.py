"""URLs derived from the vocabulary of ``documents`` that reach the rarer
branches: suffixes of the whole ICANN list (plain, wildcard, exception),
unlisted names, addresses, missing schemes, user information, ports, brackets,
parameters, queries and fragments, mixed case.

Each distinct word gives one URL; the digits of its MD5 pick the parts, so
Spark and the oracle's SQL build the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .suffixes import icann_rules, local_strings

#: Part -> (position of its MD5 digit, choices); W stands for the word.
PARTS = {
    "scheme": (5, ["http://", "https://", "HTTP://", "//", "", "ftp://", "http://", "mailto:"]),
    "user": (6, ["", "", "", "user@", "U:p@"]),
    "port": (7, ["", "", ":80", ":8080"]),
    "path": (8, ["", "/", "/A/W.html", "/x;p=1", "/a;b/W;d", "/W/2024/page1/", " /b c"]),
    "query": (9, ["", "?q=1;2", "?Q=Run+W&w=W", "?"]),
    "tail": (10, ["", "", "#f", "#W?x"]),
}
#: Hosts besides word + rule, picked by digit 4; "" means word + rule.
HOSTS = [""] * 9 + ["10.0.0.1", "localhost", "W", "W.nosuchtld", "[::1]", "bad[W", "Www.W.COM."]


def rule_hosts() -> list[str]:
    """A suffix under each ICANN rule, in list order."""
    return [r[2:] if r.startswith("*.") else r[1:] if r.startswith("!") else r for r in icann_rules()]


def doc_words(docs: DataFrame) -> DataFrame:
    """Distinct words (word) of the whole texts."""
    return docs.select(F.explode(F.split(F.trim(F.regexp_replace(
        F.lower("text"), "[^a-z0-9]+", " ")), " ")).alias("word")).filter(F.col("word") != "").distinct()


def hard_urls(docs: DataFrame) -> DataFrame:
    """(page_id, pos, url): negative page ids, pos -2."""
    suffixes = rule_hosts()
    word = doc_words(docs).select("word", F.md5("word").alias("h"))
    word = word.join(F.broadcast(local_strings(docs.sparkSession, suffixes, "suffix")),
                     F.conv(F.substring("h", 1, 4), 16, 10).cast("int") % len(suffixes) == F.col("at"))
    number = lambda at, n: F.conv(F.substring("h", at, n), 16, 10).cast("int")

    def pick(at: int, choices: list[str], n: int = 1):
        chosen = F.element_at(F.array(*[F.lit(c) for c in choices]), number(at, n) % len(choices) + 1)
        return F.replace(chosen, F.lit("W"), F.col("word"))

    host = pick(4, HOSTS)
    by_rule = F.concat("word", F.lit("."), "suffix")
    part = {k: pick(*v) for k, v in PARTS.items()}
    return word.select(
        (-F.conv(F.substring("h", 11, 12), 16, 10).cast("bigint") - 2).alias("page_id"),
        F.lit(-2).cast("bigint").alias("pos"),
        F.concat(part["scheme"], part["user"], F.when(host == "", by_rule).otherwise(host), part["port"],
                 part["path"], part["query"], part["tail"]).alias("url"))


def hard_urls_sql(words_sql: str) -> str:
    """The same rows in DuckDB; ``words_sql`` gives distinct words (word)."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    number = lambda at, n: f"('0x' || substr(h, {at}, {n}))::BIGINT"

    def pick(at, choices, n=1):
        return f"replace([{', '.join(map(q, choices))}][{number(at, n)} % {len(choices)} + 1], 'W', word)"

    host = pick(4, HOSTS)
    part = {k: pick(*v) for k, v in PARTS.items()}
    suffixes = rule_hosts()
    values = ", ".join(f"({i}, {q(s)})" for i, s in enumerate(suffixes))
    return f"""
SELECT -{number(11, 12)} - 2 AS page_id, CAST(-2 AS BIGINT) AS pos,
       {part["scheme"]} || {part["user"]} || (CASE WHEN {host} = '' THEN word || '.' || suffix
       ELSE {host} END) || {part["port"]} || {part["path"]} || {part["query"]} || {part["tail"]} AS url
FROM (SELECT word, md5(word) AS h FROM ({words_sql})) JOIN (VALUES {values}) s(nr, suffix)
     ON {number(1, 4)} % {len(suffixes)} = nr"""
