"""A re-run over the same files adds nothing; T3: each domain once."""

import os

from pyspark.sql import functions as F

from weblex.operators import terms
from weblex.session import scratch_path
from weblex.sources.pages import link_corpus
from weblex.sources.suffixes import fixture_rules
from weblex.streaming import incremental, normalize
from conftest import SF_SMALL


def test_incremental_exactly_once(spark):
    rules = fixture_rules(spark)
    root = scratch_path(spark, "t1")
    src, parts, ckpt = (os.path.join(root, d) for d in ("in", "parts", "ckpt"))
    links = link_corpus(spark, SF_SMALL)
    links.filter(F.col("page_id") < 20).select("url").write.text(os.path.join(src, "a"))
    incremental.run_incremental(spark, os.path.join(src, "*"), parts, ckpt, rules)
    first = incremental.read_partials(spark, parts).count()
    incremental.run_incremental(spark, os.path.join(src, "*"), parts, ckpt, rules)
    assert incremental.read_partials(spark, parts).count() == first
    links.filter(F.col("page_id") >= 20).select("url").write.text(os.path.join(src, "b"))
    incremental.run_incremental(spark, os.path.join(src, "*"), parts, ckpt, rules)
    merged = {(r.term, r.domain): r.n for r in incremental.merged_counts(spark, parts).collect()}
    whole = terms.term_domain_counts(terms.url_words(links, rules))
    assert merged == {(r.term, r.domain): r.n for r in whole.collect()}


def test_streaming_normalize_emits_once(spark):
    rules = fixture_rules(spark)
    root = scratch_path(spark, "t3")
    src, sink, ckpt = (os.path.join(root, d) for d in ("in", "out", "ckpt"))
    spark.createDataFrame([("www.a.com",), ("b.a.com",), ("localhost",)], "value string") \
        .write.text(os.path.join(src, "1"))
    normalize.run_normalize(spark, os.path.join(src, "*"), sink, ckpt, rules, state_partitions=4)
    spark.createDataFrame([("x.a.com",), ("c.co.uk",)], "value string").write.text(os.path.join(src, "2"))
    normalize.run_normalize(spark, os.path.join(src, "*"), sink, ckpt, rules, state_partitions=4)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").find("RocksDB") < 0
    files = [f for _, _, names in os.walk(os.path.join(ckpt.replace("file:", ""), "state")) for f in names]
    assert any(f.endswith((".changelog", ".zip")) for f in files)  # the state's files on disk
    normalize.run_normalize(spark, os.path.join(src, "*"), sink, ckpt, rules)  # a restart emits nothing twice
    assert sorted(r.domain for r in normalize.read_domains(spark, sink).collect()) == ["a.com", "c.co.uk"]


def test_incremental_recovers_from_a_failed_batch(spark, monkeypatch):
    """A batch that fails after storing its output is replayed on restart;
    what it had stored is never read: no double counts."""
    import pytest
    rules = fixture_rules(spark)
    root = scratch_path(spark, "t1-fail")
    src, parts, ckpt = (os.path.join(root, d) for d in ("in", "parts", "ckpt"))
    links = link_corpus(spark, SF_SMALL)
    links.select("url").write.text(os.path.join(src, "a"))
    original = incremental.store_batch

    def failing(*args, **kwargs):
        original(*args, **kwargs)  # stored, never published
        raise RuntimeError("simulated loss of the driver")

    monkeypatch.setattr(incremental, "store_batch", failing)
    with pytest.raises(Exception):
        incremental.run_incremental(spark, os.path.join(src, "*"), parts, ckpt, rules)
    monkeypatch.setattr(incremental, "store_batch", original)
    assert incremental.read_partials(spark, parts).count() == 0
    incremental.run_incremental(spark, os.path.join(src, "*"), parts, ckpt, rules)
    merged = {(r.term, r.domain): r.n for r in incremental.merged_counts(spark, parts).collect()}
    whole = terms.term_domain_counts(terms.url_words(links, rules))
    assert merged == {(r.term, r.domain): r.n for r in whole.collect()}


def test_nothing_arrived_yet(spark):
    parts = os.path.join(scratch_path(spark, "t2-empty"), "parts")
    assert incremental.merged_report(spark, parts).count() == 0
    for approximate in (False, True):
        assert tuple(incremental.run_stats(spark, parts, approximate).first()) == (0, 0, 0, 0, 0)
    assert not incremental.compact(spark, parts)


def test_batch_statistics_add_up(spark):
    rules = fixture_rules(spark)
    root = scratch_path(spark, "t1-stats")
    src, parts, ckpt = (os.path.join(root, d) for d in ("in", "parts", "ckpt"))
    links = link_corpus(spark, SF_SMALL)
    links.select("url").coalesce(1).write.text(os.path.join(src, "a"))
    for _ in range(2):
        incremental.run_incremental(spark, os.path.join(src, "*"), parts, ckpt, rules)
    stats = incremental.batch_stats(spark, parts).collect()
    recs = terms.url_records(links, rules)
    pairs = terms.word_domain_counts(terms.words_of(recs, mark_urls=True))
    whole = terms.corpus_stats(pairs, terms.terms_from_pairs(pairs)).first()
    assert len(stats) == 1 and tuple(stats[0])[:4] == tuple(whole)
    assert tuple(incremental.run_stats(spark, parts).first()) == (1, *whole)


def arrivals(spark, n):
    """(root, source folder, links, write the next arrival); pages overlap in
    words and domains."""
    root = scratch_path(spark, "t1-many")
    links = link_corpus(spark, SF_SMALL)

    def arrive(i):
        links.filter(F.coalesce(F.col("page_id"), F.lit(0)) % n == i).select("url").coalesce(1) \
            .write.text(os.path.join(root, "in", f"a{i}"))
    return root, os.path.join(root, "in", "*"), links, arrive


def whole_figures(links, rules):
    pairs = terms.word_domain_counts(terms.words_of(terms.url_records(links, rules), mark_urls=True))
    return tuple(terms.corpus_stats(pairs, terms.terms_from_pairs(pairs)).first())


def test_many_batches_become_one_generation(spark, monkeypatch):
    rules = fixture_rules(spark)
    root, src, links, arrive = arrivals(spark, 5)
    parts, ckpt = os.path.join(root, "parts"), os.path.join(root, "ckpt")
    want = {(r.term, r.domain): r.n for r in terms.term_domain_counts(terms.url_words(links, rules)).collect()}

    def run():
        incremental.run_incremental(spark, src, parts, ckpt, rules)

    def counts():
        return {(r.term, r.domain): r.n for r in incremental.merged_counts(spark, parts).collect()}

    for i in range(4):
        arrive(i)
        run()
    before, bound = counts(), incremental.snapshot(spark, parts)
    # A compaction killed before its record is published changes nothing.
    publish = incremental.commits.publish
    monkeypatch.setattr(incremental.commits, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    try:
        incremental.compact(spark, parts)
    except RuntimeError:
        pass
    monkeypatch.setattr(incremental.commits, "publish", publish)
    assert counts() == before and incremental.snapshot(spark, parts).folders == bound.folders
    assert incremental.compact(spark, parts)
    now = incremental.snapshot(spark, parts)
    assert len(now.folders) == 1 and now.generation == 1 and counts() == before
    assert len(now.table("counts").inputFiles()) < len(bound.table("counts").inputFiles())
    # The next arrival adds to the generation, an old reader still sees its own.
    arrive(4)
    run()
    assert counts() == want and bound.table("counts").groupBy().sum("n").first()[0] == sum(before.values())
    assert tuple(incremental.run_stats(spark, parts).first()) == (5, *whole_figures(links, rules))
    assert incremental.compact(spark, parts) and counts() == want
    removed = incremental.vacuum(spark, parts)
    assert len(removed) == 6 and counts() == want and incremental.vacuum(spark, parts)
    # A replay of a published batch (killed before the stream's own commit).
    last = max(incremental.snapshot(spark, parts).records)
    assert not publish(spark, os.path.join(parts, "log"), last, {})
    run()
    assert counts() == want and incremental.batch_stats(spark, parts).count() == 5


def test_published_batches_are_not_stored_again(spark, monkeypatch):
    """The stream dies after the batch is published, before its own commit."""
    import pytest
    rules = fixture_rules(spark)
    root, src, links, arrive = arrivals(spark, 1)
    parts, ckpt = os.path.join(root, "parts"), os.path.join(root, "ckpt")
    arrive(0)
    publish = incremental.commits.publish

    def dies(*args):
        publish(*args)
        raise RuntimeError("killed after the record")

    monkeypatch.setattr(incremental.commits, "publish", dies)
    with pytest.raises(Exception):
        incremental.run_incremental(spark, src, parts, ckpt, rules)
    monkeypatch.setattr(incremental.commits, "publish", publish)
    folders = incremental.snapshot(spark, parts).folders
    incremental.run_incremental(spark, src, parts, ckpt, rules)
    assert incremental.snapshot(spark, parts).folders == folders and len(folders) == 1
    assert tuple(incremental.run_stats(spark, parts).first()) == (1, *whole_figures(links, rules))
    # Another checkpoint is another stream: its batch 0 is not the first one's.
    incremental.run_incremental(spark, src, parts, ckpt + "-2", rules)
    assert incremental.run_stats(spark, parts).first().batches == 2


def test_statistics_from_sketches(spark):
    rules = fixture_rules(spark)
    root, src, links, arrive = arrivals(spark, 3)
    parts, ckpt = os.path.join(root, "parts"), os.path.join(root, "ckpt")
    for i in range(3):
        arrive(i)
        incremental.run_incremental(spark, src, parts, ckpt, rules, compact_after=2)
    assert incremental.snapshot(spark, parts).generation >= 1
    exact = incremental.run_stats(spark, parts).first()
    near = incremental.run_stats(spark, parts, approximate=True).first()
    assert tuple(exact) == (3, *whole_figures(links, rules)) and exact.asDict().keys() == near.asDict().keys()
    assert (near.batches, near.processed_urls, near.total_terms) == (3, exact.processed_urls, exact.total_terms)
    for c in ("unique_domains", "unique_terms"):
        assert abs(near[c] - exact[c]) <= 0.05 * exact[c]


def test_a_batch_without_any_domain(spark):
    root = scratch_path(spark, "t1-none")
    parts, ckpt = os.path.join(root, "parts"), os.path.join(root, "ckpt")
    spark.createDataFrame([("http://localhost/x",), ("",)], "value string").write.text(os.path.join(root, "in", "a"))
    incremental.run_incremental(spark, os.path.join(root, "in", "*"), parts, ckpt, fixture_rules(spark))
    for approximate in (False, True):
        assert tuple(incremental.run_stats(spark, parts, approximate).first()) == (1, 0, 0, 0, 0)
    assert incremental.merged_counts(spark, parts).count() == 0


def test_words_are_stemmed_once_over_all_batches(spark, monkeypatch):
    rules = fixture_rules(spark)
    root, src, links, arrive = arrivals(spark, 2)
    parts, ckpt = os.path.join(root, "parts"), os.path.join(root, "ckpt")
    arrive(0)
    incremental.run_incremental(spark, src, parts, ckpt, rules)
    first = {r.word for r in incremental.snapshot(spark, parts).table("stems").collect()}
    stem, asked = incremental.stem_vocabulary, []
    monkeypatch.setattr(incremental, "stem_vocabulary", lambda v, *a: asked.append(v) or stem(v, *a))
    arrive(1)
    incremental.run_incremental(spark, src, parts, ckpt, rules)
    assert first and len(asked) == 1
    plan = asked[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan
    stems = incremental.snapshot(spark, parts).table("stems").collect()
    assert len(stems) == len({r.word for r in stems}) and not first & {r.word for r in asked[0].collect()}
    words = {r.word for r in terms.url_words(links, rules).select("word").distinct().collect()}
    assert {r.word for r in stems} == words


def test_incremental_continuous_trigger(spark):
    rules = fixture_rules(spark)
    root = scratch_path(spark, "t1-cont")
    src, parts, ckpt = (os.path.join(root, d) for d in ("in", "parts", "ckpt"))
    link_corpus(spark, SF_SMALL).select("url").write.text(os.path.join(src, "a"))
    query = incremental.run_incremental(spark, os.path.join(src, "*"), parts, ckpt, rules,
                                        every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert incremental.read_partials(spark, parts).count() > 0
