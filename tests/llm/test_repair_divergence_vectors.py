"""Conversation repair, source divergence, embedding near-duplicates, against
brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from weblex.llm import components, conversations, divergence, embedding_groups, queries
from weblex.llm.conversations import Audits, Repair


# -- conversations --------------------------------------------------------

SHAPE = re.compile(r"(s?(ua)+)?")


def brute_repair(rows):
    """Every sequence of edits with up to two inserts a gap."""
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen
                      else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None

    def walk(i, cost, audit, out):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for ins in ((), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")):
            made, c, a = out + [(r, "") for r in ins], cost + 5 * len(ins), audit + "I" * len(ins)
            initials = "".join(r[:1] for r, _ in made)
            if i == len(rows):
                if SHAPE.fullmatch(initials):
                    text = "\n".join(f"{r}:{t}" for r, t in made)
                    key = (c, a, hashlib.sha256(text.encode()).hexdigest())
                    best = key if best is None or key < best else best
                continue
            if not re.fullmatch(r"s?(ua)*u?", initials):
                continue
            _, role, text = rows[i]
            walk(i + 1, c + 2, a + "D", made)
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                if role[:1] in ("s", "u", "a"):
                    walk(i + 1, c + more, a + "K", made + [(role, text)])
                for new in ("user", "assistant"):
                    walk(i + 1, c + more + 1, a + "R", made + [(new, text)])

    walk(0, 0, "", [])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, *best)


def plain_repair(rows):
    """The same programme with audits as plain strings."""
    seen, best = set(), {"": (0, "", "")}  # initials' last state -> cost, audit, text

    def put(table, state, entry):
        if state not in table or entry[:2] < table[state][:2]:
            table[state] = entry

    def joined(state, text, role, words):
        return f"{text}\n{role}:{words}" if state else f"{role}:{words}"

    after = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def insert(best):
        for _ in range(2):
            for state, (c, a, t) in list(best.items()):
                put(best, after[state][0], (c + 5, a + "I", joined(state, t, after[state], "")))

    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        gone = not solid or (role, text) in seen
        more = 5 if solid and solid[-1] not in ".!?" else 0
        seen.add((role, text))
        insert(best)
        new: dict = {}
        for state, (c, a, t) in best.items():
            put(new, state, (c + 2, a + "D", t))
            if not gone:
                if role[:1] == after[state][0] or role[:1] == "s" and state == "":
                    put(new, role[:1], (c + more, a + "K", joined(state, t, role, text)))
                put(new, after[state][0], (c + more + 1, a + "R", joined(state, t, after[state], text)))
        best = new
    insert(best)
    cost, audit, text = min(best[s] for s in ("", "a") if s in best)
    return cost, audit, hashlib.sha256(text.encode()).hexdigest()


def test_repair_is_the_cheapest_and_least():
    rnd = random.Random(1)
    for _ in range(1500):
        rows, turn = [], 0
        for _ in range(rnd.randint(0, 5)):
            turn += rnd.choice([0, 1, 1, 2])
            rows.append((rnd.choice([turn] * 4 + [None]),
                         rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", " ", ""]),
                         rnd.choice(["a.", "b!", "c", "", "  ", "d? ", "é"])))
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        one = Repair()
        for r in rows:
            one.add(*r)
        assert one.result() == brute_repair(rows)


def test_audits_compare_like_strings_though_hashes_collide():
    rnd = random.Random(2)
    for modulus in (7, conversations.MODULUS):
        audits = Audits(modulus)
        nodes = [0]
        for _ in range(400):
            nodes.append(audits.add(rnd.choice(nodes[-60:]), rnd.choice("DIKR")))
        for _ in range(4000):
            a, b = rnd.choice(nodes), rnd.choice(nodes)
            x, y = audits.text(a), audits.text(b)
            same = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert audits.common(a, b) == same and audits.less(a, b) == (x < y)
        assert audits.verified > 0  # collisions, and equal audits on nodes of their own


def test_long_conversation():
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["user", "assistant", "user", "system"]), f"{rnd.randint(0, 900)}{rnd.choice(['.', '', '!'])}")
            for i in range(3000)]
    one = Repair()
    for r in rows:
        one.add(*r)
    assert one.result()[5:] == plain_repair(rows)


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = out[conv]
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def test_repair_query_equals_plain_damage_and_programme(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: r for r in queries.op11_conversation_repair(spark, SF_SMALL).collect()}
    want = damaged(rows)
    assert set(got) == set(want)
    kinds = Counter()
    for conv, kept in want.items():
        r = got[conv]
        assert (r["cost"], r["audit"], r["repaired_sha256"]) == plain_repair(kept)
        turns = {t for t, _, _ in kept}
        assert r["gaps"] == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)
        kinds.update(r["audit"])
    assert set(kinds) == set("DKR")  # an insert always costs more than deleting what it would complete


def test_repair_odd_rows(spark):
    long = "wort " * 40_000
    rows = [(None, 1, "user", "a."), (None, None, None, None), (7, 1, "user", long + "."), (7, 1, "user", long + "."),
            (7, 2, "assistant", "b"), (8, 5, "system", "x."), (9, 3, "", "y."), (9, 4, "assistant", "z.")]
    df = spark.createDataFrame([(*r, "k", r[3]) for r in rows],
                               "conv_id long, turn long, role string, text string, key string, gone string")
    got = {r[0]: tuple(r)[1:] for r in conversations.repair(df).collect()}
    read = defaultdict(list)
    for c, t, role, text in rows:
        read[c].append((t, " " if role is None else role, " " if text is None else text))
    for c, kept in read.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        assert got[c] == brute_repair(kept)
    gone = conversations.repair(df.where("conv_id = 8"), gone=F.lit(True)).collect()
    assert tuple(gone[0]) == (8, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert conversations.repair(df.where("false")).collect() == []


# -- divergence -----------------------------------------------------------

def brute_divergence(docs, least=10, top=10):
    found, uses, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        found[lang].update(set(words))
        uses[lang, source].update(words)
    kept = {lang: [t for t, n in c.items() if n >= least] for lang, c in found.items()}
    for lang, source in groups:
        for t in kept[lang]:
            total[lang][t] += uses[lang, source][t]

    def share(n, size, v):
        return 1 + 1_000_000_000 * (n + 2) // (size + 2 * v)

    def p_of(counts, lang):
        size, v = sum(counts[t] for t in kept[lang]), len(kept[lang])
        return {t: share(counts[t], size, v) for t in kept[lang]}

    p = {g: p_of(uses[g], g[0]) for g in groups}
    out = []
    for lang, source in groups:
        mine = p[lang, source]
        parts = [("pair", other, sum((mine[t] - p[lang, other][t]) ** 2 // (mine[t] + p[lang, other][t]) for t in mine))
                 for other in (s for g, s in groups if g == lang) if other != source]
        q = p_of(total[lang], lang)
        parts += [("term", t, (mine[t] - q[t]) ** 2 // (mine[t] + q[t])) for t in mine
                  if uses[lang, source][t] and mine[t] > q[t]]
        for part in ("pair", "term"):
            ranked = sorted((x for x in parts if x[0] == part), key=lambda x: (-x[2], x[1].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (_, item, value) in enumerate(ranked)
                    if part == "pair" or i < top]
    return sorted(out)


@pytest.fixture(scope="module")
def spoken():
    rnd = random.Random(4)
    words = ["a", "The", "über", "naïve", "x1y", "Ärger", "日本", "don't", "é"] + [f"w{chr(97 + i)}{chr(97 + j)}"
                                                                          for i in range(8) for j in range(8)]
    docs = []
    for i in range(900):
        weights = [1 / (k + 1 + i % 5) for k in range(len(words))]
        docs.append((rnd.choice(["en", "de", "en", None, "xx"]) if i % 300 else "rare",
                     rnd.choice(["s1", "s1", "s2", "s3", "é", "Z", None]),
                     rnd.choice([" ".join(rnd.choices(words, weights, k=rnd.randint(0, 30))), None, "", "12 !"])))
    return docs + docs[:40]


@pytest.mark.parametrize("block, shard_docs", [(1 << 19, 8192), (40, 100)])
def test_divergence_equals_brute_force(spark, spoken, block, shard_docs):
    df = spark.createDataFrame([(*d, 1, "z") for d in spoken],
                               "lang string, source string, text string, rank int, shard string").repartition(5)
    got = divergence.divergence(df, block=block, shard_docs=shard_docs)
    assert sorted(tuple(r) for r in got.collect()) == brute_divergence(spoken)


def test_runs_merge_in_order_and_drop_rare_terms():
    rnd = random.Random(5)
    runs, docs, uses = [], Counter(), defaultdict(Counter)
    for _ in range(6):
        block = divergence.Block()
        for _ in range(50):
            words = [bytes([97 + rnd.randrange(26)]) + bytes([97 + rnd.randrange(26)]) for _ in range(rnd.randrange(1, 9))]
            source = rnd.choice("pqr")
            block.add(source, words)
            docs.update(set(words))
            for w in words:
                uses[w][source] += 1
        for shard, packed in block.run(3):
            row = dict(zip(["terms", "docs", "sizes", "sources", "counts", "names"], packed))
            runs.append((shard, divergence.Run(row)))
    got = {}
    for shard in range(3):
        mine = [r for s, r in runs if s == shard]
        merged = list(divergence.merge_runs(mine, 4))
        assert [t for t, _ in merged] == sorted(t for t, _ in merged)
        got.update(merged)
    assert got == {t: dict(uses[t]) for t, n in docs.items() if n >= 4}


def test_shared_terms_are_flushed_in_parts(spark, spoken):
    df = spark.createDataFrame(spoken, "lang string, source string, text string")
    sums, divergence.PAIR_SUMS = divergence.PAIR_SUMS, 3
    try:
        got = divergence.divergence(df).collect()
    finally:
        divergence.PAIR_SUMS = sums
    assert sorted(tuple(r) for r in got) == brute_divergence(spoken)


def test_divergence_of_nothing(spark):
    df = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.divergence(df).collect() == []
    few = spark.createDataFrame([("en", "a", "one"), ("en", "b", None)], "lang string, source string, text string")
    assert sorted(tuple(r) for r in divergence.divergence(few).collect()) == [
        ("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


# -- embeddings -----------------------------------------------------------

def brute_links(rows, threshold=0.93):
    parent, n = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    fit = [i for i, (_, v, label) in enumerate(rows) if label is not None and v
           and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1]) / np.abs(rows[i][1]).max() for i in fit}
    for k, i in enumerate(fit):
        for j in fit[k + 1:]:
            if rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                x, y = unit[i], unit[j]
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    n[i] += 1
                    n[j] += 1
                    a, b = root(i), root(j)
                    parent[max(a, b)] = min(a, b)
    least: dict = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return sorted(((key, n[i], least.get(root(i)), key == least.get(root(i))) for i, (key, _, _) in enumerate(rows)),
                  key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(12):
        base = rng.normal(size=16)
        for _ in range(rng.integers(1, 60)):
            noise = rng.choice([0, 0.1, 0.3, 0.45])
            rows.append((len(rows) * 7 % 1001, (base + rng.normal(size=16) * noise).tolist(), int(rng.integers(0, 2))))
    one = [1.0] * 16
    rows += [(None, one, 1), (5000, None, 1), (5001, [0.0] * 16, 0), (5002, [math.nan] + one[1:], 0),
             (5003, [None] + one[1:], 0), (5004, one, None), (5005, [], 0), (5006, one[1:], 1), (5007, [1e300] * 16, 1),
             (5008, [math.inf] + one[1:], 1)]
    return rows + rows[:5]


@pytest.mark.parametrize("block", [2048, 16])
def test_embedding_groups_equal_brute_force(spark, vectors, block):
    df = spark.createDataFrame([(*r, 1, 2) for r in vectors],
                               "vec_id long, embedding array<double>, label int, uid int, n int").repartition(4)
    size, embedding_groups.BLOCK = embedding_groups.BLOCK, block
    try:
        got = sorted((tuple(r) for r in embedding_groups.near_duplicates(df).collect()), key=str)
    finally:
        embedding_groups.BLOCK = size
    assert got == brute_links(vectors)


def test_recall_at_the_threshold():
    """Pairs whose cosine is just the threshold share a bucket as promised."""
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=(2, 4000, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = 0.93 * a + math.sqrt(1 - 0.93 ** 2) * b
    for most in (100, 5_000, 10**6):
        bits, tables = embedding_groups.plan_tables(most)
        x, y = (embedding_groups.signatures(v, bits, tables) for v in (a, near))
        assert (x == y).any(axis=1).mean() > 0.995


def test_embedding_groups_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    got = embedding_groups.near_duplicates(df)
    assert got.collect() == [] and got.columns == ["vec_id", "n_links", "component_id", "kept"]


def test_components_of_a_star_and_a_path(spark):
    star = [(10_000, i) for i in range(3000)]
    path = [(20_000 + i, 20_001 + i) for i in range(200)]
    odd = [(5, 5), (None, 3), (30_000, 30_001), (30_001, 30_000)]
    edges = spark.createDataFrame(star + path + odd, "a long, b long").repartition(4)
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    want = {i: 0 for i in range(1, 3000)} | {10_000: 0} | {20_000 + i: 20_000 for i in range(1, 201)} | {30_001: 30_000}
    assert got == want
