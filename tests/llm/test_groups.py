"""Operators that exchange rows: sharding, SimHash groups, exact top-k,
packing, WARC bundles; and the pipeline."""

import base64
import hashlib
import io
import random
from collections import defaultdict
from math import comb

import numpy as np
import pytest
import xxhash
import zstandard
from conftest import SF_SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from weblex.llm import packing, queries, quality, sharding, simhash, topk, toxicity, warc


# -- sharding -------------------------------------------------------------

def test_hypergeometric_is_exact():
    rng = np.random.default_rng(1)
    good, total, draws, n = 7, 20, 9, 20_000
    seen = np.bincount([sharding.hypergeometric(good, total, draws, rng) for _ in range(n)], minlength=8)
    want = np.array([comb(good, k) * comb(total - good, draws - k) / comb(total, draws) for k in range(8)])
    assert np.abs(seen / n - want).max() < 0.015
    big = sharding.hypergeometric(10**10, 4 * 10**10, 10**9, rng)
    assert abs(big - 25 * 10**7) < 10**6


def test_matrix_sums():
    counts = [5, 0, 17, 1000, 3]
    m = sharding.communication_matrix(counts, 4)
    assert m.sum(axis=1).tolist() == counts and (m >= 0).all()
    assert sorted(m.sum(axis=0)) == [256, 256, 256, 257]


@pytest.mark.parametrize("rows", [0, 1, 37, 4000])
def test_shards_are_exact_and_gapless(spark, rows):
    sharding_bucket, sharding.BUCKET = sharding.BUCKET, 50
    try:
        df = spark.range(rows).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("doc_id"),
                                      F.lit("x").alias("k"), F.lit(1).alias("bucket")).repartition(5)
        got = sharding.shuffle_into_shards(df, 16).collect()
    finally:
        sharding.BUCKET = sharding_bucket
    assert len(got) == rows
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    if rows == 4000:
        ids = [r["doc_id"] for r in got if r["doc_id"] is not None]
        assert sorted(ids) == [i for i in range(rows) if i % 10]
        first = sorted((r["slot"], r["doc_id"]) for r in got if r["shard"] == 0 and r["doc_id"] is not None)
        order = [i for _, i in first]
        assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.25


def test_sharding_query(spark):
    got = queries.op1_sharding(spark, SF_SMALL)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in got.collect():
        data = docs[r["doc_id"]].encode()
        import zlib
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)


# -- SimHash --------------------------------------------------------------

def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    out = 0
    for bit in range(64):
        votes = sum(xxhash.xxh64_intdigest(r, seed=42) >> bit & 1 for r in runs)
        out |= (2 * votes > len(runs)) << bit
    return out


def brute_groups(fps, limit):
    u = np.array(sorted(set(fps)), np.uint64)
    label = np.arange(len(u))
    for i in range(len(u)):
        near = np.flatnonzero(np.bitwise_count(u ^ u[i]) <= limit)
        for old in set(label[near]):
            label[label == old] = label[near].min()
    return {int(f): int(x) for f, x in zip(u, label)}


def test_fingerprints_and_index_against_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        text = " ".join(rng.choices(["A", "b", "Ñ", "c\n", "\u00a0"], k=rng.randint(0, 9)))
        assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)
    gen = np.random.default_rng(2)
    for n in (1, 16, 17, 300, 2500):
        seeds = gen.integers(0, 2**63, max(1, n // 4), dtype=np.uint64)
        codes = np.unique(seeds[gen.integers(0, len(seeds), n)] ^ (np.uint64(1) << gen.integers(0, 64, n).astype(np.uint64)))
        codes = codes[np.argsort(simhash.gray_rank(codes))]
        for limit in (0, 2, 5):
            got = set()
            for q, m in simhash.GrayIndex(codes).search(codes, limit):
                got |= set(zip(q.tolist(), m.tolist()))
            assert got == set(zip(*map(np.ndarray.tolist, np.nonzero(
                np.bitwise_count(codes[:, None] ^ codes[None, :]) <= limit))))


@pytest.mark.parametrize("block", [64, 100_000])
def test_groups_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "SLICE", 4 * block)
    gen = np.random.default_rng(block)
    seeds = gen.integers(0, 2**63, 60, dtype=np.uint64)
    codes = seeds[gen.integers(0, 60, 700)]
    for _ in range(3):  # chains: a few single-bit steps from a seed
        codes = codes ^ (np.uint64(1) << gen.integers(0, 12, 700).astype(np.uint64))
    codes[:5] = 0
    rows = [(i, int(c.astype(np.int64)), i) for i, c in enumerate(codes)]
    df = spark.createDataFrame(rows, "doc_id long, fp long, uid long")
    got = {r["fp"] % 2**64: r for r in simhash.groups(df, "doc_id").collect()}
    label = brute_groups([int(c) for c in codes], 2)
    least = {}
    for i, c in enumerate(codes):
        least.setdefault(label[int(c)], i)
    assert {f: r["component_id"] for f, r in got.items()} == {f: least[x] for f, x in label.items()}


def test_near_duplicates_odd_rows(spark):
    long = "w1 w2 w3 " * 50_000
    rows = [(4, None, "x"), (2, "", "x"), (2, "", "x"), (9, "a b c d", "x"), (None, "A b C d", "x"), (7, "u v", "x"), (8, long, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = simhash.near_duplicates(df, keep=["doc_id"]).collect()
    assert len(got) == 7 and sum(r["is_kept"] for r in got) == 4
    assert {r["component_id"] for r in got if r["fp"] == 0} == {2}
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [9]
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 7, 8, 9]
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_simhash_query(spark):
    got = queries.op2_simhash_groups(spark, SF_SMALL).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    fps = {i: plain_fingerprint(t) for i, t in docs.items() if len(t) < 2000}
    assert all(r["fingerprint"] == f"{fps[r['doc_id']]:016x}" for r in got if r["doc_id"] in fps)
    label, least = brute_groups([int(r["fingerprint"], 16) for r in got], 2), {}
    for r in sorted(got, key=lambda r: r["doc_id"]):
        least.setdefault(label[int(r["fingerprint"], 16)], r["doc_id"])
    assert all(r["component_id"] == least[label[int(r["fingerprint"], 16)]] for r in got)


# -- exact top-k ----------------------------------------------------------

def brute_top(rows, k):
    out = []
    for qi, q in {(i, tuple(v)) for i, v in rows if i % 5 == 0}:
        best = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in rows if i != qi)[:k]
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("chunk,queries_,big", [(16384, 2048, 1), (40, 7, 1), (40, 7, 10**8)])
def test_top_k_against_brute_force(spark, monkeypatch, chunk, queries_, big):
    monkeypatch.setattr(topk, "CHUNK", chunk)
    monkeypatch.setattr(topk, "QUERIES", queries_)
    gen = np.random.default_rng(chunk)
    rows = [(i, [int(x) * big for x in gen.integers(-3, 4, 6)]) for i in range(300)]
    df = spark.createDataFrame([(i, [float(x) for x in v], "s") for i, v in rows],
                               "vec_id long, embedding array<double>, score string")
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=7, scale=1)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 7)


def test_top_k_skips_blocks_of_unlike_rows(spark, monkeypatch):
    """Clusters: most blocks and most chunks stay out, results stay whole."""
    monkeypatch.setattr(topk, "CHUNK", 500)
    gen = np.random.default_rng(8)
    centres = gen.normal(size=(24, 16)) * 12
    rows = [(i, np.rint(centres[gen.integers(24)] + gen.normal(size=16)).astype(int).tolist()) for i in range(6000)]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    asks = F.col("vec_id") % 300 == 0
    got = topk.top_k(df, asks, k=7, scale=1).collect()
    v = np.array([r[1] for r in rows])
    want = []
    for q in range(0, 6000, 300):
        s = v @ v[q]
        best = [i for i in np.lexsort((np.arange(6000), -s)) if i != q][:7]
        want += [(q, r + 1, int(i), int(s[i])) for r, i in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)
    spent = topk.candidates(df, asks, k=7, scale=1).agg(F.sum("scored"), F.sum("asked")).first()
    every = 20 * -(-6000 // topk.BLOCK)
    assert spent[0] < 0.35 * every


def test_top_k_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (1, [1.0, None]), (2, None), (3, [nan, 1.0]), (4, [1.0, 1.0]), (None, [1.0, 1.0]),
            (5, [float("inf"), 0.0]), (20, [-0.5, 0.1]), (6, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0).collect()))
    assert got == [(0, 1, 4, 64 * 64 + 128 * 64), (0, 2, 6, 0), (0, 3, 20, 64 * -32 + 128 * 6),
                   (20, 1, 6, 0), (20, 2, 0, 64 * -32 + 128 * 6), (20, 3, 4, 64 * -32 + 64 * 6)]
    assert {r[2] for r in got} == {0, 4, 6, 20}
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# -- packing --------------------------------------------------------------

def test_fill_respects_every_limit():
    gen = np.random.default_rng(3)
    limits = np.array([100, 6, 60])
    for cut in (False, True):
        tokens = gen.integers(1, 100, 400)
        loss = tokens if cut else np.minimum(gen.integers(0, 60, 400), tokens)
        lim = np.array([100, 6, 100]) if cut else limits
        seqs = packing.fill(np.stack([tokens, loss], axis=1), lim, cut)
        used = defaultdict(list)
        for s in seqs:
            assert sum(n for _, _, n in s) <= lim[0] and len(s) <= lim[1]
            if not cut:
                assert sum(loss[i] for i, _, _ in s) <= lim[2]
            for i, a, n in s:
                used[i].append((a, n))
        for i, t in enumerate(tokens):
            at = 0
            for a, n in sorted(used[i]):
                assert a == at and n > 0
                at += n
            assert at == t
        floor = max(-(-tokens.sum() // lim[0]), -(-400 // lim[1]), 0 if cut else -(-loss.sum() // lim[2]))
        assert len(seqs) <= 1.25 * floor
    with pytest.raises(ValueError):
        packing.fill(np.array([[101, 0]]), limits)


def test_documents_are_packed_whole(spark, monkeypatch):
    from weblex.llm.tokens import Encoder
    path = queries.tokenizer_path()
    long = "alpha beta gamma delta " * 20_000
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y z", "a"), (3, "x y z", "a"), (4, long, "a")] + \
           [(10 + i, "some words of text " * (i % 50), "a") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").coalesce(1)
    got = packing.pack_documents(df, path).collect()
    enc = Encoder(path)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for key, text, _ in rows:
        ids = np.append(np.frombuffer(enc.encode([text or ""])[0], "<u4"), 1).tolist()
        pieces = sorted(by_doc[key], key=lambda r: r["start"])
        if key != 3:
            assert [x for r in pieces for x in np.frombuffer(r["ids"], "<u4").tolist()] == ids
        assert all(r["doc_tokens"] == len(ids) and r["length"] == len(r["ids"]) // 4 for r in pieces)
    sizes = []
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.TOKENS
        sizes.append(at)
    assert sum(s < packing.TOKENS for s in sizes) <= 1
    assert packing.pack_documents(df.limit(0), path).count() == 0


def test_short_documents_leave_no_padding(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("the").alias("text")).coalesce(1)
    path = queries.tokenizer_path()
    sizes = [r["n"] for r in packing.pack_documents(docs, path).groupBy("sequence_id")
             .agg(F.sum("length").alias("n")).collect()]
    assert sum(sizes) == 12_000 and sorted(sizes)[1:] == [packing.TOKENS] * 5
    few = packing.pack_documents(docs, path, segments=128).groupBy("sequence_id").count().collect()
    assert max(r["count"] for r in few) == 128


def test_waiting_tokens_are_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "word " * 3000) for i in range(40)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(packing, "GROUP_TOKENS", 5000)
    got = packing.pack_documents(docs, queries.tokenizer_path()).collect()
    want = 40 * (len(queries_encoder().encode(["word " * 3000])[0]) // 4 + 1)
    assert sum(r["length"] for r in got) == want


def queries_encoder():
    from weblex.llm.tokens import Encoder
    return Encoder(queries.tokenizer_path())


def test_examples_stay_whole(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, rng.randint(0, 100), None if i % 50 == 0 else rng.randint(0, 40)) for i in range(500)]
    df = spark.createDataFrame(rows, "example_id long, n_tokens int, n_loss int").repartition(3)
    got = packing.pack_examples(df, 100, 5, 50).collect()
    assert sorted(r["example_id"] for r in got) == list(range(500))
    seqs = defaultdict(list)
    for r in got:
        seqs[r["sequence_id"]].append(r)
    for s in seqs.values():
        assert sum(r["n_tokens"] for r in s) <= 100 and len(s) <= 5 and sum(r["n_loss"] for r in s) <= 50


# -- WARC -----------------------------------------------------------------

def test_bundle_round_trip_and_seek_table():
    sink = io.BytesIO()
    writer = warc.BundleWriter(sink, frame=500)
    records = [warc.record(f"<urn:page:{i}>", "response", "http://x/\r\n", b"p" * (i * 37 % 900), "S", None) for i in range(50)]
    places = [writer.add(r) for r in records]
    writer.finish()
    assert places[-1][0] > 5
    reader = warc.BundleReader(sink)
    for i in random.Random(1).sample(range(50), 50):
        frame, offset = places[i]
        head, block, end = warc.parse(reader.frame(frame), offset)
        assert head["WARC-Record-ID"] == f"<urn:page:{i}>" and block == b"p" * (i * 37 % 900)
        assert end - offset == len(records[i])
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(sink.getvalue()), read_across_frames=True).read()
    assert plain == b"".join(records)


def test_archive_odd_rows(spark):
    big = "é" * 400_000
    rows = [(3, "http://a", "same", "x"), (1, None, "same", "x"), (1, None, "same", "x"), (2, "http://b", None, "x"),
            (5, "http://c", "", "x"), (6, "http://d", big, "x"), (None, "http://e", "same", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, bundle string")
    folder = warc.fresh_folder(spark)
    got = warc.read_records(warc.write_archive(df, folder), folder).collect()
    want = {(i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), k, r)
            for (i, _, h, _), (k, r) in zip(rows, [("revisit", 1), ("response", None), ("response", None),
                                                   ("response", None), ("revisit", 2), ("response", None), ("revisit", 1)])}
    assert {tuple(r)[:5] for r in got} == want and len(got) == 7
    assert [r["payload"] for r in got if r["page_id"] == 6] == [big.encode()]
    empty = warc.fresh_folder(spark)
    assert warc.read_records(warc.write_archive(df.limit(0), empty), empty).count() == 0


# -- pipeline -------------------------------------------------------------

def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.collect()
    columns = docs.columns
    good = corpus_pipeline.quality_rules(spark, docs, SF_SMALL)
    assert good.columns == columns
    kept = {r["doc_id"] for r in good.collect()}
    policy = quality.POLICIES[quality.DEFAULT_POLICY]
    for r in rows:
        m = dict(zip(quality.MEASURES, quality.measure(r["text"])))
        base = m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]
        bits = sum(1 << i for i, (_, c) in enumerate(quality.RULES) if eval(c, {}, m))
        hard = bool(bits & policy.hard) or bin(bits & policy.soft).count("1") >= policy.soft_limit
        assert (r["doc_id"] in kept) == (not base and not hard)
    clean = corpus_pipeline.toxicity_filter(spark, good, SF_SMALL)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = toxicity.fit(good, labels)
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in good.collect() if model.score(r["text"]) < 0.5}
    alone = corpus_pipeline.near_duplicates(spark, clean, SF_SMALL).collect()
    fps = {r["doc_id"]: simhash.fingerprint(r["text"]) % 2**64 for r in clean.collect()}
    label, least = brute_groups(list(fps.values()), 2), {}
    for i in sorted(fps):
        least.setdefault(label[fps[i]], i)
    assert sorted(r["doc_id"] for r in alone) == sorted(least.values())
    single = spark.createDataFrame(alone, docs.schema)
    mixed = corpus_pipeline.mix_sources(spark, single, SF_SMALL)
    assert mixed.columns == columns and {r["doc_id"] for r in mixed.collect()} == set(least.values())
    out = corpus_pipeline.pack(spark, single, SF_SMALL).collect()
    assert {r["doc_id"] for r in out} == set(least.values())
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0


def test_stages_keep_clashing_columns_and_odd_rows(spark):
    from weblex.llm.common import stored
    extra = ["n_words", "kept", "score", "_score", "_fp", "_uid", "fp", "rate", "copies", "posterior", "_doc", "_row"]
    text = " ".join(f"Word{i}" for i in range(40))
    rows = [(i, t, "en", "s", 1, *[f"{c}{i}" for c in extra]) for i, t in
            [(1, text), (2, text), (2, text), (3, None), (4, ""), (5, text + " x " * 9), (None, text[:200] * 3)]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra)
    docs = spark.createDataFrame(rows, schema)
    for empty in (False, True):
        now = stored(docs.limit(0) if empty else docs, "odd")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stored(stage(spark, now, SF_SMALL), f"odd-{name}")
            assert now.columns == docs.columns, name
            got = [tuple(r) for r in now.collect()]
            assert set(got) <= set(rows) and (got or empty or name != "quality_rules"), name
        assert corpus_pipeline.pack(spark, now, SF_SMALL).count() >= (0 if empty else 1)
