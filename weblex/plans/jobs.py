"""End-to-end jobs (Q1-Q6) composed from the operators.

Each job is a DataFrame -> DataFrame function; inputs and outputs are plain
tables so the jobs can be chained or fed by any source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import strip_text, url_host
from ..operators import ranking, terms
from ..operators.dedup import distinct_per_file, drop_adjacent_repeats
from ..operators.domains import present, registered_only
from ..sources.lines import sample_every_nth
from ..sources.suffixes import SuffixRules
from .materialize import materialize


def term_report(td: DataFrame, share: float = 0.8,
                max_domains: int = 1000) -> DataFrame:
    """W1-W5 over stored pair counts: term, frequency, domains (top domains by
    count)."""
    tc = terms.term_counts(td)
    kept = materialize(ranking.share_cutoff(tc, share), "kept-terms")  # few rows, read twice
    # Kept terms first, so that the long tail is neither ranked nor shuffled.
    top = ranking.top_domains(ranking.restrict_to(td, kept), max_domains, pairs=td)
    lists = ranking.domain_lists(top)
    return (kept.join(lists, "term")
                .select("term", F.col("n").alias("frequency"), "domains")
                .orderBy(F.desc("frequency"), F.asc("term")))


def term_frequency(urls: DataFrame, rules: SuffixRules, url_col: str = "url",
                   share: float = 0.8, max_domains: int = 1000, min_len: int = 3,
                   stopwords: list[str] | None = None,
                   store: str = "parquet") -> DataFrame:
    """Q4: URLs -> term, frequency, comma-joined top domains.

    The pair counts (term, domain, n) are stored once (``materialize``) so
    the small cutoff action and the final report read them instead of
    recomputing the whole scan.
    """
    words = terms.url_words(urls, rules, url_col, min_len, stopwords)
    td = materialize(terms.term_domain_counts(words, min_len), "term-domain", store)
    return term_report(td, share, max_domains)


def extract_hosts(index: DataFrame) -> DataFrame:
    """Q1: distinct hosts per index file: (file_path, host)."""
    hosts = index.select("file_path", url_host(F.col("url")).alias("host"))
    # Rows without a host are dropped inside the generator, so the host
    # expression is not copied into a pushed-down filter.
    return hosts.select(F.inline(present("host", "file_path", "host"))).distinct()


def extract_urls(index: DataFrame) -> DataFrame:
    """Q2: distinct URLs per index file: (file_path, url)."""
    return distinct_per_file(index, "url")


def normalize_domains(hosts: DataFrame, rules: SuffixRules, col: str = "host") -> DataFrame:
    """Q3: unique registered domains of a host list."""
    df = hosts.select(strip_text(F.col(col)).alias(col))
    return registered_only(df, col, rules, stripped=True).distinct()


def normalize_domains_in_order(hosts: DataFrame, rules: SuffixRules, order: str,
                               col: str = "host", split: list[str] | None = None) -> DataFrame:
    """Q3, exact variant: registered domains with adjacent repeats dropped
    (D4), in ``order``: (order, domain).  With ``split`` (see ``mark_runs``)
    rows stay where they are."""
    df = hosts.select(order, *(split or []), strip_text(F.col(col)).alias(col))
    norm = registered_only(df, col, rules, keep=(order, *(split or [])), stripped=True)
    return drop_adjacent_repeats(norm, "domain", order, split=split)


def sampled_term_frequency(urls: DataFrame, rules: SuffixRules, every: int,
                           ordinal: str, share: float = 0.8, max_domains: int = 1000,
                           min_len: int = 3, store: str = "parquet") -> DataFrame:
    """Q5: every Nth URL (by a dense 1-based ordinal), then Q4."""
    return term_frequency(sample_every_nth(urls, every, ordinal), rules, "url",
                          share, max_domains, min_len, store=store)


def first_seen_term_frequency(urls: DataFrame, rules: SuffixRules, order: str,
                              share: float = 0.8, max_domains: int = 1000,
                              min_len: int = 3, store: str = "parquet") -> DataFrame:
    """Q6: Q4 with each term's first ``max_domains`` distinct domains in
    input order (W4) instead of its most frequent ones.

    The pair table carries the first position a pair was seen, so the
    same pre-aggregation as Q4 serves both counts and first-seen order.  Word
    pairs are stored once; the vocabulary and the counts read them.
    """
    words = terms.url_words(urls, rules, "url", min_len, keep=(order,))
    pairs = materialize(terms.word_domain_counts(words, first_seen=order), "word-domain-first", store)
    td = materialize(terms.terms_from_pairs(pairs, min_len, first_seen=order), "term-domain-first", store)
    kept = materialize(ranking.share_cutoff(terms.term_counts(td), share), "kept-terms", store)
    first = ranking.first_seen_rank(ranking.restrict_to(td, kept), max_domains, pairs=td)
    lists = ranking.domain_lists(first)
    return (kept.join(lists, "term")
                .select("term", F.col("n").alias("frequency"), "domains")
                .orderBy(F.desc("frequency"), F.asc("term")))


def analyze(urls: DataFrame, rules: SuffixRules, url_col: str = "url",
            share: float = 0.8, max_domains: int = 1000, min_len: int = 3,
            stopwords: list[str] | None = None, store: str = "parquet"):
    """Q4 and its run statistics (A6) from one pass over the URLs.

    Returns (report, stats).  The URL-marked pair counts are stored once;
    term counts (stored too) and statistics are derived from them, so the
    per-URL stage runs a single time for both outputs.
    """
    recs = terms.url_records(urls, rules, url_col)
    marked = terms.words_of(recs, min_len, stopwords, mark_urls=True)
    wd = materialize(terms.word_domain_counts(marked), "pairs-marked", store)
    td = materialize(terms.terms_from_pairs(wd, min_len), "term-domain", store)
    return term_report(td, share, max_domains), terms.corpus_stats(wd, td)
