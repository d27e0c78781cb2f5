"""Plan properties the performance relies on (checked on executed plans)."""

import re

from pyspark.sql import functions as F

from weblex.operators import terms
from weblex.operators.stemming import stem_dictionary
from weblex.plans import catalog, jobs
from weblex.plans.catalog import q1_extract_hosts
from weblex.plans.materialize import materialize
from weblex.sources.pages import link_corpus
from weblex.sources.suffixes import fixture_rules
from conftest import SF_SMALL


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def filter_lines(plan: str):
    return [line for line in plan.split("\n") if re.search(r"\bFilter\b", line)]


def pairs(spark):
    words = terms.url_words(link_corpus(spark, SF_SMALL), fixture_rules(spark))
    return terms.term_domain_counts(words)


def final_plan(plan: str) -> str:
    m = re.search(r"== Final Plan ==\n(.*?)\+- == Initial Plan ==", plan, re.S)
    return m.group(1) if m else plan


def test_pair_counts_plan(spark):
    plan = executed(pairs(spark))
    assert "ReusedExchange" in plan
    # With AQE off every branch stays in the plan: the per-URL stage (token
    # explode) must appear once, the vocabulary branches reusing its shuffle.
    static = spark.newSession()
    static.conf.set("spark.sql.adaptive.enabled", "false")   # child session only
    static_plan = executed(pairs(static))
    assert static_plan.count("Generate explode(CASE WHEN (isnotnull(domain") == 1
    assert not re.search(r"MapInPandas|EvalPython", plan)  # no Python in the hot path
    # no filter re-evaluates the domain or URL-part expressions
    assert not any("_rd_" in line or "regexp_extract" in line for line in filter_lines(plan))


def test_report_plan_limits_before_term_shuffle(spark):
    plan = executed(jobs.term_report(materialize(pairs(spark), "plan-test"), 0.8, 5))
    partial = plan.find("WindowGroupLimit")
    assert partial >= 0
    assert re.search(r"WindowGroupLimit .*Partial", plan)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_stem_chain_plan_stays_small(spark):
    words = spark.createDataFrame([("running",), ("generalizations",)], "word string")
    df = stem_dictionary(words.filter(F.length("word") > 0), "word", 3)
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 60_000
    assert sorted(df.collect()) == [("generalizations", "gener"), ("running", "run")]


def test_host_extraction_evaluates_host_once(spark):
    plan = executed(q1_extract_hosts(spark, SF_SMALL))
    assert not any("instr(lower(regexp_extract" in line for line in filter_lines(plan))


def test_first_seen_pairs_parse_once(spark):
    static = spark.newSession()
    static.conf.set("spark.sql.adaptive.enabled", "false")   # child session only
    links = link_corpus(static, SF_SMALL).withColumn("ord", F.struct("page_id", "pos"))
    words = terms.url_words(links, fixture_rules(static), keep=("ord",))
    plan = executed(terms.word_domain_counts(words, first_seen="ord"))  # the job stores them
    assert plan.count("Generate explode(CASE WHEN (isnotnull(domain") == 1


def test_union_of_partials_counts_null_and_negative_pages(spark, tmp_path):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    odd = pages.withColumn("page_id", F.when(F.col("page_id") % 5 == 0, F.lit(None))
                           .otherwise(-F.col("page_id") * 37).cast(pages.schema["page_id"].dataType))
    odd.write.parquet(f"{tmp_path}/pages.parquet")
    got = catalog.QUERIES["d6_union_partials"](spark, str(tmp_path)).collect()
    want = terms.term_domain_counts(catalog._batched_words(spark, str(tmp_path)), by=("batch",)).collect()
    batches = {r["batch"] for r in want}
    assert None in batches and any(b is not None and b % 3 and b < 0 for b in batches)
    key = lambda r: (r["batch"], r["term"], r["domain"], r["n"])
    assert sorted(map(key, got), key=str) == sorted(map(key, want), key=str)
    # Incremental runs take the same pages in, null and negative ids in the second arrival.
    whole = {(r.term, r.domain): r.n for r in catalog._td(spark, str(tmp_path)).collect()}
    for name in ("t1_incremental_partials", "t1_compacted_partials"):
        assert {(r.term, r.domain): r.n for r in catalog.QUERIES[name](spark, str(tmp_path)).collect()} == whole
    first = catalog.QUERIES["w4_first_seen_domains"](spark, str(tmp_path)).collect()
    assert {r.rank for r in first} <= {1, 2, 3} and {r.term for r in first} == {t for t, _ in whole}
