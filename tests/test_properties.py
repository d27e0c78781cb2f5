"""Properties: merging partials over any split equals the whole count (A7);
sampling with N=1 is the identity (S5)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weblex.operators import counts, terms
from weblex.operators.ordinal import with_ordinal
from weblex.sources.lines import sample_every_nth
from weblex.sources.pages import link_corpus
from weblex.sources.suffixes import fixture_rules
from conftest import SF_SMALL


@settings(max_examples=4, deadline=None)
@given(st.integers(min_value=0, max_value=60))
def test_partials_merge_to_whole(spark, cut):
    rules = fixture_rules(spark)
    links = link_corpus(spark, SF_SMALL).withColumn(
        "batch", (F.col("page_id") >= cut).cast("int"))
    words = terms.url_words(links, rules, keep=("batch",))
    merged = counts.merge_partials(terms.term_domain_counts(words, by=("batch",)))
    whole = terms.term_domain_counts(terms.url_words(link_corpus(spark, SF_SMALL), rules))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))


def test_sampling_one_is_identity(spark):
    links = with_ordinal(link_corpus(spark, SF_SMALL), [F.asc("page_id"), F.asc("pos")], "o")
    assert sample_every_nth(links, 1, "o").count() == links.count()


def test_salted_stem_join_same_counts(spark, monkeypatch):
    rules = fixture_rules(spark)
    words = terms.url_words(link_corpus(spark, SF_SMALL), rules)
    plain = sorted(map(tuple, terms.term_domain_counts(words).collect()))
    monkeypatch.setattr(terms, "HOT_PAIRS", 1)
    salted = terms.term_domain_counts(words)
    assert sorted(map(tuple, salted.collect())) == plain


def test_analyze_matches_separate_jobs(spark):
    from weblex.plans import jobs
    rules = fixture_rules(spark)
    links = link_corpus(spark, SF_SMALL)
    report, stats = jobs.analyze(links, rules)
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, jobs.term_frequency(links, rules).collect()))
    s = stats.first()
    recs = terms.url_records(links, rules).filter("domain is not null")
    assert s.processed_urls == recs.count()
    assert s.unique_domains == recs.select("domain").distinct().count()
