"""Row-wise operators: quality ledger, token counts, licence scans, toxicity,
memberships; brute force, DuckDB twins and defined results for odd rows."""

import math
import os
import random
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import ROOT, SF_SMALL
from pyspark.sql import functions as F

from weblex.llm import licenses, mixing, queries, quality, tokens, toxicity

sys.path.insert(0, os.path.join(ROOT, "tools"))
import oracle_check  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Score string, n_words string, FP string"
LONG = "alpha beta gamma delta " * 60_000
ODD = [
    (1, None, None, None, None, "x", "y", "z"),
    (2, "", "en", "s", 0, None, None, None),
    (3, "one two three", "en", "s", 3, "x", "y", "z"),
    (3, "one two three", "en", "s", 3, "x", "y", "z"),
    (None, "released under the MIT License", "en", "s", 3, "x", "y", "z"),
    (5, LONG, "en", "s", 3, "x", "y", "z"),
    (6, " \t\n\x0b\x0c\r ", "en", "s", 3, "x", "y", "z"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    msg, ok = oracle_check.compare(spark, oracle_check.duck(SF_SMALL), name, queries.QUERIES[name],
                                   queries.SQL[name], SF_SMALL)
    assert ok, msg


# -- quality --------------------------------------------------------------

def brute_repeats(words, w=8):
    runs = [tuple(words[i:i + w]) for i in range(len(words) - w + 1)]
    covered = {i + o for i, r in enumerate(runs) if runs.count(r) > 1 for o in range(w)}
    return len(covered)


def test_repeated_words_against_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            words += words[:rng.randint(0, len(words))]
        assert quality.repeated_words(words) == brute_repeats(words)


def test_ledger_odd_rows_and_empty_table(spark, odd):
    led = quality.judge(quality.ledger(odd))
    assert led.columns == ["doc_id", "text", "lang", "source", "n_chars", "Score", "FP", *quality.MEASURES,
                           "fail_bits", "base_failed", "kept", "freed_bits"]
    rows = by_id(led)
    assert rows[1]["n_words"] == rows[2]["n_words"] == rows[6]["n_words"] == 0
    assert rows[1]["fail_bits"] & quality.BIT["few_words"] and not rows[1]["kept"]
    assert rows[5]["n_words"] == 240_000 and rows[5]["n_repeat_words"] == 240_000
    assert led.where("doc_id = 3").count() == 2
    assert quality.judge(quality.ledger(odd.limit(0))).count() == 0


def test_policies_and_ablations(spark):
    led = spark.createDataFrame([(b,) for b in (0, 1, 1, 2, 3, 8, 20)], "fail_bits long")
    kept = {r["fail_bits"]: r["kept"] for r in quality.judge(led).collect()}
    assert kept == {0: True, 1: False, 2: False, 3: False, 8: False, 20: False}
    assert [r["kept"] for r in quality.judge(led, "base-1").where("fail_bits = 8").collect()] == [True]
    got = {r["rule"]: (r["n_failed"], r["n_freed"]) for r in quality.ablations(led).collect()}
    assert got["few_words"] == (3, 2) and got["repeated_words"] == (2, 1) and got["symbols"] == (1, 1)
    assert got["duplicate_lines"] == (1, 1) and got["capitals"] == (0, 0)
    freed = {r["fail_bits"]: r["freed_bits"] for r in quality.judge(led).collect()}
    policy = quality.POLICIES[quality.DEFAULT_POLICY]

    def rejected(bits):
        return bool(bits & policy.hard) or bin(bits & policy.soft).count("1") >= policy.soft_limit

    assert freed == {b: sum(bit for bit in quality.BIT.values() if rejected(b) and not rejected(b & ~bit)) for b in freed}
    assert freed[3] == 0 and freed[20] == 20


# -- token counts ---------------------------------------------------------

PIECES = ["a", "b", " ", "  ", "\n", " \n", "é", "<|endoftext|>", "'s", "1", "\t", " x", "the ", "\x1c", "中", "!",
          "\u200b", "\u00a0", "<|", "hello", " World"]


@pytest.mark.parametrize("window,overlap,huge", [(tokens.WINDOW, tokens.OVERLAP, tokens.HUGE), (24, 4, 20), (7, 2, 5)])
def test_encoder_equals_library(window, overlap, huge):
    enc = tokens.Encoder(queries.tokenizer_path(), window, overlap, huge)
    rng = random.Random(window)
    for _ in range(3000):
        text = "".join(rng.choices(PIECES, k=rng.randint(0, 40)))
        want = enc._tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == want, text


def test_words_of_letters_skip_the_search_for_pre_tokens():
    """op6 was over its CPU budget: every new word went through the library's
    pre-tokenizer, and words with other marks at the end were new ones."""
    enc = tokens.Encoder(queries.tokenizer_path())
    rng = random.Random(6)
    words = ["".join(rng.choices("abcxyzABÀßéñœŠž", k=rng.randrange(1, 12))) for _ in range(3000)]
    texts = [" ".join(w + rng.choice(["", "***", ",", '")', "$$$.", "|>"]) for w in words[i:i + 100])
             for i in range(0, len(words), 100)]
    whole, seen = enc._whole, []
    enc._whole = lambda parts: seen.extend(parts) or whole(parts)
    counts, ids = enc.ids(pa.array(texts))
    want = [enc._tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
    assert sum(map(len, seen)) < sum(map(len, texts)) / 20


def test_units_of_all_kinds_equal_the_library_when_the_memory_overflows(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_ENTRIES", 150)
    monkeypatch.setattr(tokens, "TOGETHER", 7)
    enc = tokens.Encoder(queries.tokenizer_path())
    rng = random.Random(7)
    letters = [chr(c) for c in range(0x180) if chr(c).isalpha()]
    others = list(tokens.MARKS) + ["'s", "'", "'LL", "\u00ad", "\u00a0", "\u0661", "7", "½", "中", "\u0301", "\n", "\t"]
    for _ in range(20):
        units = ["".join(rng.choices(letters if rng.random() < 0.5 else letters[:52] + others * 3, k=rng.randrange(0, 6)))
                 for _ in range(200)] + ["old", "older", "old***", "'s", "***"]
        rng.shuffle(units)
        texts = [" ".join(units[i:i + 5]) for i in range(0, len(units), 5)] + [None, ""]
        counts, ids = enc.ids(pa.array(texts))
        want = [enc._tok.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
        assert enc.counts(pa.array(texts)).tolist() == counts.tolist()


def test_splice_widens_when_no_boundary_is_stable():
    enc = tokens.Encoder(queries.tokenizer_path())
    text = "x" * 5000 + " y" + "\n" * 3000 + "z z z"
    got = tokens.splice(enc._with_offsets, text, window=64, overlap=8)
    assert got == enc._tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(spark, odd, name):
    path = queries.tokenizer_path(name)
    got = by_id(tokens.count_tokens(odd.where("doc_id in (2, 3)"), path))
    assert got[2]["n_tokens"] == 0 and got[3]["n_tokens"] >= 3


def test_token_counts_odd_rows(spark, odd):
    path = queries.tokenizer_path()
    out = tokens.count_tokens(odd, path, keep=["doc_id"])
    rows = by_id(out)
    assert rows[1]["n_tokens"] == rows[2]["n_tokens"] == rows[1]["n_bytes"] == 0
    lib = tokens.Encoder(path)._tok
    want = sorted((str(key), len(lib.encode(text or "", add_special_tokens=False).ids)) for key, text, *_ in ODD)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in out.collect()) == want
    assert tokens.count_tokens(odd.limit(0), path).count() == 0


# -- licences -------------------------------------------------------------

def test_nested_regions_and_unpaired_marks():
    a = licenses.Automaton("x", "alpha [[beta [[gamma]] delta]] [[[[one]] two]] omega")
    ok = ["alpha omega", "alpha beta delta omega", "alpha beta gamma delta omega", "alpha two omega",
          "alpha beta delta one two omega"]
    bad = ["alpha beta omega", "alpha gamma omega", "alpha one omega", "alpha beta gamma omega", "alpha delta omega"]
    for text in ok + bad:
        words = licenses.words_of(text)
        assert (a.accepts(words, 0) == len(words)) == (text in ok), text
    for template in ("alpha ]] beta", "alpha [[ beta", "alpha [[ b ]] ]] c"):
        with pytest.raises(ValueError):
            licenses.Automaton("x", template)


COMMON = "/usr/share/common-licenses"


@pytest.mark.skipif(not os.path.exists(f"{COMMON}/BSD"), reason="no licence texts on this machine")
def test_whole_licence_texts_as_templates(spark):
    """Whole texts are templates whose names may be replaced; one changed
    mandatory word is refused."""
    with open(f"{COMMON}/BSD", encoding="utf-8") as f:
        text = f.read()
    words = [w.decode() for w in licenses.words_of(text)]
    holder = "the regents of the university of california"
    plain = " ".join(words)
    assert plain.count(holder) >= 1
    template = plain.replace(holder, "{{12}}", 1)
    renamed = text.replace("The Regents of the University of California", "Nobody & Sons, Inc.", 1)
    changed = text.replace("Redistributions", "Distributions", 1)
    docs = spark.createDataFrame([(1, text), (2, renamed), (3, changed), (4, f"/* {text} */ int main() {{}}")],
                                 "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(docs, templates=[("bsd", template)]).collect()}
    assert got == {1: "bsd", 2: "bsd", 3: "", 4: "bsd"}


def test_template_markup():
    a = licenses.Automaton("x", "[[this {{2}} is]] under the x license {{3}} end")
    ok = ["this is under the x license end", "this a b is under the x license 1 2 3 end", "under the x license end"]
    bad = ["under the x licence end", "under x license end", "under the x license 1 2 3 4 end"]
    for text in ok:
        words = licenses.words_of(text)
        assert a.accepts(words, 0) == len(words), text
    for text in bad:
        words = licenses.words_of(text)
        assert all(a.accepts(words, i) is None for i in range(len(words))), text


def test_scan_against_brute_force():
    scan = licenses._scanner(licenses.TEMPLATES)
    rng = random.Random(5)
    bits = ["Under the MIT license", "under THE mit-license", "Apache License, Version 2", ".0", "cc by-nc", "licensed",
            "by", "x", "ü", "under the", "Licensed under the GNU General Public License, version 3", "4.0", "\n"]
    for _ in range(300):
        text = " ".join(rng.choices(bits, k=rng.randint(0, 14)))
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        at, labels = [], set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            here = [i for i in range(len(words)) if words[i:i + len(p)] == p]
            at += here
            labels |= {label} if here else set()
        n, n_base, first, last, base, every, score, spans = (x[0] for x in scan([text]))
        assert (n, n_base, first, last) == (len(words), len(at), min(at, default=None), max(at, default=None))
        assert base == ",".join(sorted(labels)) and set(labels) <= set(every.split(","))
        assert score == (1.0 if spans else 0.5 if labels else 0.0)


def test_scan_odd_rows(spark, odd):
    out = licenses.scan_licenses(odd)
    rows = by_id(out)
    assert "n_words" in out.columns and out.columns.count("n_words") == 1
    assert rows[1]["labels"] == "" and rows[1]["first_word"] is None and rows[1]["score"] == 0.0
    assert rows[None]["labels"] == "mit" and rows[None]["score"] == 1.0
    assert [tuple(s) for s in rows[None]["spans"]] == [("mit", 0, 5)]
    assert licenses.scan_licenses(odd.limit(0)).count() == 0


# -- toxicity -------------------------------------------------------------

def synthetic(n, seed, bad=("vrakulo", "zbinto", "morgefu")):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdeilnorst", k=rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(5, 80))
        toxic = i % 3 == 0
        if toxic:
            for _ in range(max(1, len(words) // 20)):
                w = rng.choice(bad)
                if rng.random() < 0.5:  # a misspelling
                    j = rng.randrange(len(w))
                    w = w[:j] + rng.choice("xyz") + w[j + 1:]
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def plain_grams(word):
    """Buckets of a word's n-grams, one character after the other."""
    chars, out = [ord(c) for c in f"<{word}>"], []
    for n in range(toxicity.SHORTEST, toxicity.LONGEST + 1):
        for i in range(len(chars) - n + 1):
            h = 0
            for c in chars[i:i + n]:
                h = (h * 0x100000001B3 + c + 1) % 2**64
            x = h * 0x9E3779B97F4A7C15 % 2**64
            out.append(((x ^ (x >> 29)) >> 7) % toxicity.BUCKETS)
    return out


def test_subwords_match_plain_loops():
    words = ["a", "ab", "vrakulo", "über", "日本", "x" * 40, "abcabc", "😀ok"]
    of, bucket, size = toxicity.subwords(words)
    for i, w in enumerate(words):
        assert sorted(bucket[of == i].tolist()) == sorted(plain_grams(w)) and size[i] == len(plain_grams(w))


def test_training_matches_a_plain_gradient():
    """Vectors and softmax by loops over documents, words and n-grams."""
    rows = [(t, y) for _, t, y in synthetic(24, 3)]
    epochs, dim = 4, toxicity.DIM
    model = toxicity.train([t for t, _ in rows], [y for _, y in rows], epochs=epochs)
    soft, bias = np.random.default_rng(7).normal(0, 1, dim), 0.0
    emb = {g: np.zeros(dim) for t, _ in rows for w in toxicity.words_of(t) for g in plain_grams(w)}
    share = sum(y for _, y in rows) / len(rows)
    moments = {}

    def adam(name, grad, t):
        m, v = moments.get(name, (0.0, 0.0))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        moments[name] = m, v
        return toxicity.RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + toxicity.DAMP)

    for t in range(1, epochs + 1):
        grads, soft_grad, bias_grad = {g: toxicity.DECAY * e for g, e in emb.items()}, toxicity.DECAY * soft, 0.0
        for text, y in rows:
            words = toxicity.words_of(text)
            vec = sum(np.mean([emb[g] for g in plain_grams(w)], axis=0) for w in words) / math.sqrt(len(words))
            z = toxicity.GAIN * float(vec @ soft) + bias
            d = (1 / (1 + math.exp(-z)) - y) * 0.5 / len(rows) / (share if y else 1 - share)
            bias_grad += d
            soft_grad = soft_grad + toxicity.GAIN * d * vec
            for w in words:
                grams = plain_grams(w)
                for g in grams:
                    grads[g] = grads[g] + toxicity.GAIN * d / math.sqrt(len(words)) / len(grams) * soft
        for g in emb:
            emb[g] = emb[g] - adam(g, grads[g], t)
        soft, bias = soft - adam("soft", soft_grad, t), bias - adam("bias", bias_grad, t)
    assert abs(model.bias - bias) < 1e-6
    got, want = np.array([model.weights[g] for g in emb]), np.array([e @ soft for e in emb.values()])
    assert np.allclose(got, want, atol=1e-5) and np.abs(want).max() > 0.1
    # A score is the same sum, word by word.
    text = rows[0][0] + " vrakulo"
    words = toxicity.words_of(text)
    z = toxicity.GAIN * sum(np.mean([model.weights[g] for g in plain_grams(w)]) for w in words) / math.sqrt(len(words))
    assert abs(model.score(text) - 1 / (1 + math.exp(-(z + model.bias)))) < 1e-5


def test_a_repeated_id_teaches_once(spark):
    rows = synthetic(60, 4)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(rows[0][0], rows[0][1])] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    assert len(toxicity.sample(docs, labels, "toxic", {0: 100, 1: 100})) == \
        sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _, _ in rows)


def test_toxicity_learns_and_holds_out(spark):
    rows = synthetic(3000, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model).withColumn("held", toxicity.held_out()).collect()
    truth = {i: y for i, _, y in rows}
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    held = [(truth[r["doc_id"]], r["score"] >= 0.5) for r in out if r["held"]]
    assert np.mean([y == p for y, p in held]) > 0.9
    # Held-out labels change nothing.
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(docs, flipped)
    assert np.array_equal(model.weights, again.weights) and model.bias == again.bias


def test_toxicity_odd_rows(spark, odd):
    none = toxicity.fit(odd, spark.createDataFrame([(3, None), (5, 1)], "doc_id long, toxic int"))
    assert none.weights is None
    model = toxicity.train(*zip(*[(t, y) for _, t, y in synthetic(60, 2)]), epochs=5)
    out = toxicity.score(odd, model)
    assert "Score" not in out.columns  # gives way to the result
    rows = by_id(out)
    assert rows[1]["score"] == rows[2]["score"] == rows[6]["score"] == 0.0
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert toxicity.score(odd.limit(0), model).count() == 0
    assert by_id(odd.select("doc_id", toxicity.held_out().alias("h")))[None]["h"] is True


def test_queries_return_their_contracts(spark):
    """The queries without SQL, on the smallest tables."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    lib = tokens.Encoder(queries.tokenizer_path())._tok
    size = {r["doc_id"]: len(lib.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs}
    counted = queries.op9_token_counts(spark, SF_SMALL).collect()
    assert {(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in counted} == \
        {(r["doc_id"], len((r["text"] or "").encode()), size[r["doc_id"]], size[r["doc_id"]] > 512) for r in docs}
    toxic = queries.op3_toxicity(spark, SF_SMALL).collect()
    assert len(toxic) == len(docs)
    for r in toxic:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    pieces = queries.op6_packing(spark, SF_SMALL).collect()
    total, room = {}, {}
    for r in pieces:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
        room.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert r["doc_tokens"] == size[r["doc_id"]] + 1
    assert total == {i: n + 1 for i, n in size.items()}
    for held in room.values():
        ends = [0, *np.cumsum([n for _, n in sorted(held)]).tolist()]
        assert [a for a, _ in sorted(held)] == ends[:-1] and ends[-1] <= 2048
    rates = queries.op4_mixing_rates(spark, SF_SMALL).collect()
    assert len(rates) == len(docs) and all(r["rate"] >= 1 and abs(r["copies"] - r["rate"]) < 1 for r in rates)
    reached = sum(np.array(r["posterior"]) * r["n_tokens"] * r["rate"] for r in rates)
    wanted = np.array(list(queries.TARGETS.values()))
    assert np.abs(reached / reached.sum() / wanted - 1).max() < max(mixing.TOLERANCE, rates[0]["gap"]) + 1e-6


# -- mixing ---------------------------------------------------------------

def mixing_rows():
    rng = random.Random(9)
    words = {"en": ["the", "and", "of", "house"], "fr": ["le", "et", "de", "maison"]}
    rows = []
    for i in range(300):
        lang = "en" if i % 4 else "fr"
        n = rng.randint(1, 60)
        rows.append((i, " ".join(rng.choices(words[lang], k=n)), lang))
    return rows


def test_rates_meet_targets_and_match_brute_force(spark):
    rows = mixing_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, rate string").repartition(3)
    labelled = docs.select("doc_id", F.col("rate").alias("domain")).where("doc_id < 200")
    goal = {"en": 0.4, "fr": 0.6}
    out = mixing.mix(docs, labelled, goal)
    assert out.columns == ["doc_id", "text", "n_tokens", "posterior", "rate", "copies", "gap", "shares"]
    got = out.collect()
    total = sum(np.array(r["posterior"]) * r["n_tokens"] * r["rate"] for r in got)
    assert np.allclose(total / total.sum(), [0.4, 0.6], atol=1e-3)
    assert np.allclose(total / total.sum(), got[0]["shares"]) and got[0]["gap"] < mixing.TOLERANCE
    assert all(r["rate"] > 1 - 1e-9 and abs(r["copies"] - r["rate"]) < 1 for r in got)


def brute_posterior(docs, labelled, domains, text):
    """Word by word, in plain floats."""
    counts = {d: [0] * mixing.BUCKETS for d in domains}
    for key, words in docs:
        for w in words.lower().split():
            counts[labelled[key]][zlib.crc32(w.encode()) % mixing.BUCKETS] += 1
    logs = {}
    for d in domains:
        size = sum(counts[d]) + mixing.BUCKETS
        seen = [math.log((counts[d][zlib.crc32(w.encode()) % mixing.BUCKETS] + 1) / size) for w in text.lower().split()]
        logs[d] = mixing.SHARPNESS * sum(seen) / len(seen)
    top = max(logs.values())
    odds = [math.exp(logs[d] - top) for d in domains]
    return [x / sum(odds) for x in odds]


def test_posteriors_match_word_by_word_bayes(spark):
    rows = mixing_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = mixing.mix(docs, docs.select("doc_id", F.col("lang").alias("domain")).where("doc_id < 40"),
                     {"en": 0.5, "fr": 0.5}).collect()
    label = {i: lang for i, _, lang in rows}
    taught = [(i, t) for i, t, _ in rows if i < 40]
    for r in out[::7]:
        assert np.allclose(r["posterior"], brute_posterior(taught, label, ["en", "fr"], r["text"]), atol=1e-4)


def test_iterations_match_projected_gradient_in_numpy(spark):
    """The same steps over rates that are held, cut at zero on the way."""
    rng = np.random.default_rng(5)
    p, n = rng.dirichlet([0.4, 0.3, 0.3], 300), rng.integers(1, 60, 300).astype(float)
    members = spark.createDataFrame([(int(b), a.tolist()) for a, b in zip(p, n)],
                                    "n_tokens long, posterior array<double>").repartition(3)
    w = np.array([0.8, 0.15, 0.05])
    fit = mixing.fit_rates(members, dict(zip("abc", w)), budget=2000.0)
    assert len(fit.plan) >= 3 and fit.gap < mixing.TOLERANCE
    gram = (p * n[:, None]).T @ p
    metric = np.linalg.inv(gram + 1e-9 * np.trace(gram) * np.eye(3))
    r = y = np.ones(300)
    for restart, momentum, step in fit.plan:
        y = r if restart else y
        assert np.allclose(step, metric @ ((y * n) @ p - 2000 * w))
        new = np.clip(y - p @ step, 0, mixing.MOST_COPIES)
        y, r = new + momentum * (new - r), new
    got = [x[0] for x in members.select(mixing.rate_column(fit)).collect()]
    assert np.allclose(sorted(got), sorted(r)) and min(r) == 0
    assert np.allclose((r * n) @ p, fit.total)


def members_of(spark, rows):
    return spark.createDataFrame(rows, "n_tokens long, posterior array<double>").coalesce(2).cache()


def test_rates_of_a_rare_domain_meet_targets(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        lean = rng.uniform(0.005, 0.05)
        rows.append((rng.randint(1, 60) * (1 if i % 10 else 2), [1 - lean, lean]))
    rare = sum(n for n, _ in rows) * 0.005
    rows += [(int(rare / 4), [0.1, 0.9])] * 4
    fit = mixing.fit_rates(members_of(spark, rows), {"en": 0.6, "es": 0.4})
    assert fit.gap < mixing.TOLERANCE
    p, n = np.array([q for _, q in rows]), np.array([k for k, _ in rows], float)
    got = [r[0] for r in members_of(spark, rows).select(mixing.rate_column(fit)).collect()]
    total = (np.array(got) * n) @ p
    assert np.allclose(total / total.sum(), [0.6, 0.4], atol=1e-3)


def test_mix_of_half_a_percent_meets_targets(spark):
    rows = [(i, " ".join(["le et de maison" if i % 200 == 0 else "the and of house"] * 10), "fr" if i % 200 == 0 else "en")
            for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = mixing.mix(docs, docs.select("doc_id", F.col("lang").alias("domain")), {"en": 0.6, "fr": 0.4}).collect()
    total = sum(np.array(r["posterior"]) * r["n_tokens"] * r["rate"] for r in out)
    assert np.allclose(total / total.sum(), [0.6, 0.4], atol=1e-3)
    assert min(r["rate"] for r in out) > 1 - 1e-9


def test_rates_cut_at_zero_meet_targets_or_the_gap_is_reported(spark):
    rows = [(10, [0.95, 0.05])] * 50 + [(10, [0.5, 0.5])] * 50 + [(10, [0.05, 0.95])] * 50
    members = members_of(spark, rows)
    fit = mixing.fit_rates(members, {"en": 0.92, "fr": 0.08}, budget=1000.0)
    assert np.allclose(fit.total, fit.goal, rtol=1e-3)
    fit = mixing.fit_rates(members, {"en": 0.98, "fr": 0.02}, budget=1000.0)
    assert fit.gap > mixing.TOLERANCE
    # The least-squares best uses the purest rows only.
    rates = np.array([r[0] for r in members.select(mixing.rate_column(fit)).collect()])
    assert rates[50:].max() == 0 and rates[:50].min() > 1.9
    with pytest.warns(RuntimeWarning, match="largest relative gap"):
        mixing.report(["en", "fr"], fit)


def test_rates_of_at_least_one_meet_targets_far_from_the_data(spark):
    sharp = [[0.98 if a == b else 0.02 / 3 for b in range(4)] for a in range(4)]
    rows = [(10, sharp[0])] * 3988 + [(10, sharp[a]) for a in (1, 2, 3) for _ in range(4)]
    fit = mixing.fit_rates(members_of(spark, rows), {"a": 0.5, "b": 0.19, "c": 0.18, "d": 0.13})
    assert fit.gap < mixing.TOLERANCE and fit.passes < 20
    rates = [r[0] for r in members_of(spark, rows).select(mixing.rate_column(fit)).collect()]
    assert min(rates) >= 1 and max(rates) <= mixing.MOST_COPIES
    few = mixing.fit_rates(members_of(spark, rows), {"a": 0.5, "b": 0.19, "c": 0.18, "d": 0.13}, most_copies=50)
    rates = [r[0] for r in members_of(spark, rows).select(mixing.rate_column(few)).collect()]
    assert few.gap > mixing.TOLERANCE and 1 <= min(rates) and max(rates) <= 50


def test_flat_posteriors_and_a_single_labelled_domain(spark):
    flat = [[0.45 if a == b else 0.55 / 3 for b in range(4)] for a in range(4)]
    rows = [(10, flat[a]) for a, k in enumerate((61, 15, 16, 8)) for _ in range(k)]
    weights = {"a": 0.5, "b": 0.19, "c": 0.18, "d": 0.13}
    fit = mixing.fit_rates(members_of(spark, rows), weights)  # no document gives half its tokens to a
    assert mixing.TOLERANCE < fit.gap < 1 and np.isfinite(fit.total).all()
    docs = spark.createDataFrame([(i, f"the house {i}") for i in range(20)], "doc_id long, text string")
    for labelled in ("SELECT 1L AS doc_id, 'a' AS domain", "SELECT 1L AS doc_id, 'other' AS domain"):
        out = mixing.mix(docs, spark.sql(labelled), weights).collect()
        assert [r["copies"] for r in out] == [1] * 20 and out[0]["gap"] == 0
    # Three of a domain among four thousand: as many copies as allowed, no more.
    docs = spark.createDataFrame([(i, "le maison" if i < 3 else "the house") for i in range(4000)], "doc_id long, text string")
    labelled = docs.select("doc_id", F.when(F.col("doc_id") < 3, "b").otherwise("a").alias("domain"))
    with pytest.warns(RuntimeWarning):
        out = mixing.mix(docs, labelled, {"a": 0.5, "b": 0.5}).collect()
    assert max(r["copies"] for r in out) == mixing.MOST_COPIES and min(r["copies"] for r in out) >= 1


def test_mixing_odd_rows(spark, odd):
    labelled = spark.createDataFrame([(3, "en"), (5, None), (1, "fr")], "doc_id long, domain string")
    rows = by_id(mixing.mix(odd, labelled, {"en": 0.5, "fr": 0.5}))
    assert rows[1]["n_tokens"] == 0 and rows[1]["rate"] == 1.0 and rows[1]["copies"] == 1
    assert sum(1 for _ in rows) == 6
    assert mixing.mix(odd.limit(0), labelled, {"en": 0.5, "fr": 0.5}).count() == 0
