"""J1 on random hosts against a direct reading of the public suffix
algorithm (longest matching rule; an exception rule prevails and drops its
leftmost label; registered domain = public suffix + one non-empty label;
trailing root dots are dropped first).  Both Spark paths are checked:
hash-set lookups and per-depth joins."""

import random

import pytest

from weblex.operators import domains
from weblex.operators.domains import registered_domain
from weblex.sources.suffixes import builtin_rules, icann_rules

LABELS = ["co", "th", "bd", "lt", "cloud", "公司", "cn", "www", "a", "b", "city", "kobe", "jp", "ck", "co", "uk", "com", "example", "k12",
          "ma", "us", "pvt", "foo", "1", ""]

CASES = {"a.f.co.th": "f.co.th", "co.th": None, "x.y.lt": "y.lt", "x.bg": None, "a.shop.bg": "shop.bg", "a.b.cloud": "b.cloud",
         "a.b.公司.cn": "b.公司.cn", "a.b.xn--55qx5d.cn": "b.xn--55qx5d.cn", "a.b.nosuchtld": None}


def expected(host: str, rules: list[str]):
    plain = {r for r in rules if not r.startswith(("*.", "!"))}
    wild = {r[2:] for r in rules if r.startswith("*.")}
    exc = {r[1:] for r in rules if r.startswith("!")}
    labels = host.rstrip(".").split(".")
    n = len(labels)
    best, exception = 0, None
    for k in range(1, n + 1):
        tail = ".".join(labels[-k:])
        if tail in exc:
            exception = k - 1 if exception is None else max(exception, k - 1)
        if tail in plain:
            best = max(best, k)
        if tail in wild and n > k:
            best = max(best, k + 1)
    length = exception if exception is not None else best
    if length < 1 or n < length + 1 or labels[-(length + 1)] == "":
        return None
    return ".".join(labels[-(length + 1):])


_rng = random.Random(7)
SAMPLE = sorted({".".join(_rng.choice(LABELS) for _ in range(_rng.randint(1, 6)))
                 for _ in range(4000)} - {""})


@pytest.mark.parametrize("inline", [True, False])
def test_random_hosts(spark, monkeypatch, inline):
    if not inline:
        monkeypatch.setattr(domains, "INLINE_RULES_LIMIT", 0)
    hosts = sorted({*SAMPLE, *CASES})
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = dict(registered_domain(df, "h", builtin_rules(spark)).select("h", "domain").collect())
    want = {h: expected(h, icann_rules()) for h in hosts}
    assert len(hosts) > 1000 and sum(v is not None for v in want.values()) > 300
    assert {h: d for h, d in got.items() if "xn--" not in h} == {h: d for h, d in want.items() if "xn--" not in h}
    assert {h: got[h] for h in CASES} == CASES
