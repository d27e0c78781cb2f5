"""URLs -> filtered, stemmed terms and their counts.

Per URL (in this order): registered domain (URLs without one are skipped,
F5) -> url parts (P1) -> site label (P4) -> tokens (P5) -> min length (F1)
-> stopwords (F2) -> noise words (F3) -> stem (P6) -> min stem length (F4).
Repeats inside a URL count every time; stop and noise lists are tested on
the unstemmed word.

The heavy part is per-row and stays in one codegen stage: regexes, the
suffix-rule lookups, explode and filters.  Counting happens on
(word, domain) first, with map-side partial aggregation, so the stem join
and everything after it see one row per distinct pair instead of one row
per occurrence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import default_stopwords
from ..functions.urls import (is_noise_word, site_label, strip_text, url_parts,
                              url_tokens)
from ..sources.suffixes import SuffixRules
from .domains import registered_domain
from .partitioning import spread
from .stemming import guard, stem_vocabulary, vocabulary

# A word with more (word, domain) rows than this is "hot": its rows are
# spread over several join keys (salted) instead of one task.
HOT_PAIRS = 1_000_000
MAX_HOT = 4096


def url_records(urls: DataFrame, rules: SuffixRules, url_col: str = "url",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Stripped URLs with their registered domain: keep..., url, domain.

    ``domain`` is null for URLs that are skipped (F5: blank, or no
    registered domain); rows with a domain are the "processed" URLs.
    Nothing is filtered here: consumers drop the skipped rows inside their
    generator or aggregate, so the domain expression is evaluated once.
    """
    df = spread(urls).select(*keep, strip_text(F.col(url_col)).alias("url"))
    return registered_domain(df, "url", rules, "domain", stripped=True)


def words_of(records: DataFrame, min_len: int = 3,
             stopwords: list[str] | None = None,
             keep: tuple[str, ...] = (), mark_urls: bool = False) -> DataFrame:
    """Kept words (F1-F3) of processed URLs: keep..., domain, word.

    URLs without a domain (F5) or with a bad netloc yield no tokens; that
    test sits inside the explode, evaluated once per URL.  With
    ``mark_urls`` every processed URL also yields one row whose word is
    null, so URL statistics and word counts come out of one pass (the null
    word never gets a stem, so term counts ignore it).
    """
    stop = default_stopwords() if stopwords is None else stopwords
    p = url_parts(F.col("url"))
    df = records.select(*keep, "domain", p.alias("_p"))
    tokens = url_tokens(site_label(F.col("_p.netloc")), F.col("_p.path"), F.col("_p.query"))
    if mark_urls:
        none = F.array().cast("array<string>")
        marked = F.concat(F.array(F.lit(None).cast("string")),
                          F.when(F.col("_p.valid"), tokens).otherwise(none))
        rows = F.when(F.col("domain").isNotNull(), marked)
    else:
        rows = F.when(F.col("domain").isNotNull() & F.col("_p.valid"), tokens)
    df = df.select(*keep, "domain", F.explode(rows).alias("word"))
    cond = (F.length("word") >= min_len) & ~is_noise_word(F.col("word"))
    if stop:
        cond = cond & ~F.col("word").isin(stop)
    if mark_urls:
        cond = F.col("word").isNull() | cond
    return df.filter(cond)


def url_words(urls: DataFrame, rules: SuffixRules, url_col: str = "url",
              min_len: int = 3, stopwords: list[str] | None = None,
              keep: tuple[str, ...] = ()) -> DataFrame:
    return words_of(url_records(urls, rules, url_col, keep), min_len, stopwords, keep)


def url_terms(urls: DataFrame, rules: SuffixRules, url_col: str = "url",
              min_len: int = 3, stopwords: list[str] | None = None,
              keep: tuple[str, ...] = (), store: str = "parquet") -> DataFrame:
    """One row per term occurrence: keep..., domain, term.

    The word rows are stored once (``store``) and read twice, for the
    vocabulary and for the join; two branches over the raw URLs would parse
    every URL twice, as nothing is shuffled before they part.
    """
    from ..plans.materialize import materialize
    words = materialize(url_words(urls, rules, url_col, min_len, stopwords, keep),
                        "url-words", store)
    vocab = vocabulary(words, "word")
    return (join_stems(words, vocab, min_len, salt_cols=("domain", *keep))
            .select(*keep, "domain", "term"))


def word_domain_counts(words: DataFrame, first_seen: str | None = None,
                       by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., word, domain, n[, first_seen]): occurrences per pair,
    partial-aggregated map-side; ``first_seen`` keeps the smallest value of
    that order column; ``by`` adds grouping keys (e.g. a batch id)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if first_seen:
        aggs.append(F.min(first_seen).alias("first_seen"))
    return words.groupBy(*by, "word", "domain").agg(*aggs)


def term_domain_counts(words: DataFrame, min_len: int = 3,
                       first_seen: str | None = None,
                       by: tuple[str, ...] = ()) -> DataFrame:
    """A4: (by..., term, domain, n[, first_seen]) from kept words."""
    return terms_from_pairs(word_domain_counts(words, first_seen, by), min_len, first_seen, by)


def terms_from_pairs(wd: DataFrame, min_len: int = 3, first_seen: str | None = None,
                     by: tuple[str, ...] = (), stems: DataFrame | None = None) -> DataFrame:
    """(word, domain) counts -> (term, domain) counts (stem join, J2); with
    ``stems`` by a stored dictionary (word, term) that has every word."""
    vocab = vocabulary(wd, "word", weight="n")
    aggs = [F.sum("n").cast("bigint").alias("n")]
    if first_seen:
        aggs.append(F.min("first_seen").alias("first_seen"))
    return join_stems(wd, vocab, min_len, stems=stems).groupBy(*by, "term", "domain").agg(*aggs)


def join_stems(wd: DataFrame, vocab: DataFrame, min_len: int,
               salt_cols: tuple[str, ...] = ("domain",), stems: DataFrame | None = None) -> DataFrame:
    """Attach each word's term to the (word, domain, ...) rows.

    The word -> term table is joined on word; AQE broadcasts it when its
    measured size is small.  When it is not, a word held by a large share of
    all domains would put all its rows in one join task, so words with more
    than HOT_PAIRS rows get a spread factor f: their rows take a salt
    hash(salt_cols) mod f, their dictionary entry is repeated for salts
    0..f-1, and the join key is (word, salt).  The hot-word table is
    broadcast; it has the MAX_HOT most frequent of them at most, and any other
    word fewer than 1 / MAX_HOT of all rows.
    """
    spread_by = F.greatest(F.lit(1), F.ceil(F.col("pairs") / F.lit(HOT_PAIRS))).cast("int")
    # The guard reads every vocabulary column, like the stem branch, so both
    # keep the same input aggregate and reuse one shuffle.
    hot = (vocab.filter((F.col("pairs") > HOT_PAIRS) & guard(vocab))
                .orderBy(F.desc("pairs"), "word").limit(MAX_HOT)
                .select("word", spread_by.alias("_f")))
    salt = F.when(F.col("_f").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*salt_cols), F.col("_f")).cast("int"))
    salted = wd.join(F.broadcast(hot), "word", "left").withColumn("_salt", salt).drop("_f")
    if stems is None:
        stems = stem_vocabulary(vocab, min_len, keep=("pairs",))
    else:
        stems = vocab.select("word", "pairs").join(stems, "word").filter(F.length("term") >= min_len)
    spread = stems.select("word", "term", F.explode(F.sequence(F.lit(0), spread_by - 1)).alias("_salt"))
    return salted.join(spread, ["word", "_salt"]).drop("_salt")


def term_counts(td: DataFrame) -> DataFrame:
    """A3: (term, n) occurrences per term, from the pair counts."""
    return td.groupBy("term").agg(F.sum("n").cast("bigint").alias("n"))


def total_occurrences(td: DataFrame) -> DataFrame:
    """A5: one row, total term occurrences."""
    return td.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_terms"))


def corpus_stats(wd: DataFrame, td: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A6 (A8 with ``by``): processed URLs, distinct domains, distinct terms,
    occurrences.

    ``wd`` are pair counts of URL-marked words (``words_of(mark_urls=True)``:
    a null word counts processed URLs), ``td`` the term counts derived from
    the same ``wd``; one aggregate over the union of both, with conditional
    columns instead of filters, so the URL stage runs once.
    """
    url_row = F.col("word").isNull()
    a = wd.select(*by, F.when(url_row, F.col("n")).alias("_u"),
                  F.when(url_row, F.col("domain")).alias("domain"),
                  F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("n"))
    b = td.select(*by, F.lit(None).cast("bigint").alias("_u"),
                  F.lit(None).cast("string").alias("domain"), F.col("term"), F.col("n"))
    grouped = a.unionByName(b).groupBy(*by) if by else a.unionByName(b)
    return grouped.agg(
        F.coalesce(F.sum("_u"), F.lit(0)).cast("bigint").alias("processed_urls"),
        F.countDistinct("domain").alias("unique_domains"),
        F.countDistinct("term").alias("unique_terms"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_terms"))
