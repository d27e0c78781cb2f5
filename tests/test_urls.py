"""Edge rows for P1, P2, P3, P4, P5, F3 (FIXTURES.md)."""

import os

import pytest
from pyspark.sql import functions as F

from weblex.functions.urls import (is_noise_word, lenient_host, site_label,
                                   url_host, url_parts, url_tokens)
from weblex.operators import domains
from weblex.operators.domains import registered_domain, registered_only
from weblex.sources.suffixes import read_suffix_rules

from conftest import PSL_FILE


def one_col(spark, values, expr, name="v"):
    df = spark.createDataFrame([(v,) for v in values], f"{name} string")
    return [r[0] for r in df.select(expr(F.col(name))).collect()]


def test_url_parts(spark):
    urls = ["https://www.Example.com:8080/A/b.html;jsess=1?q=Running+Dogs#frag",
            "http://x.com?q=1;2", "//cdn.x.org/y", "example.com/path", "mailto:a@b.com",
            "http://bad[host/z"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    rows = df.select(url_parts(F.col("u")).alias("p")).select("p.*").collect()
    got = [(r.netloc, r.path, r.query, r.valid) for r in rows]
    assert got[0] == ("www.example.com:8080", "/a/b.html", "q=running+dogs", True)
    assert got[1] == ("x.com", "", "q=1;2", True)
    assert got[2] == ("cdn.x.org", "/y", "", True)
    assert got[3] == ("", "example.com/path", "", True)
    assert got[4] == ("", "a@b.com", "", True)
    assert got[5][3] is False


def test_params_only_for_param_schemes(spark):
    got = one_col(spark, ["http://h/a;x", "mailto:a;b", "foo/b;c/d;e"],
                  lambda c: url_parts(c)["path"])
    assert got == ["/a", "a;b", "foo/b;c/d"]


def test_host(spark):
    got = one_col(spark, ["http://Host.com:80/", "http://user:pw@h.co.uk/", "example.com/x",
                          "http://bad[host/z", None], url_host)
    assert got == ["host.com", "user", None, None, None]


HOSTS = {
    "www.example.com": "example.com",
    "blog.example.co.uk": "example.co.uk",
    "a.foo.ck": "a.foo.ck",
    "x.www.ck": "www.ck",
    "c.a.b.kobe.jp": "a.b.kobe.jp",
    "x.city.kobe.jp": "city.kobe.jp",
    "s3.amazonaws.com": "amazonaws.com",
    "http://user:pw@WWW.Example.COM:8080/path?q#f": "example.com",
    "//cdn.example.org/x": "example.org",
    "example.com.": "example.com",
    "a..com": None,
    "co.uk": None, "com": None, "foo.ck": None, "localhost": None,
    "192.168.0.1": None, "example.nosuchtld": None, "": None, "   ": None,
    "[::1]": None, "http://[2001:db8::1]/x": None,
}


def _domains(spark, rules):
    df = spark.createDataFrame([(h,) for h in HOSTS], "h string")
    return dict(registered_domain(df, "h", rules).select("h", "domain").collect())


def test_registered_domain_builtin(spark, rules):
    assert _domains(spark, rules) == HOSTS


def test_registered_domain_join_path(spark, rules, monkeypatch):
    """Large rule sets use broadcast joins: same answers."""
    monkeypatch.setattr(domains, "INLINE_RULES_LIMIT", 0)
    assert _domains(spark, rules) == HOSTS


@pytest.mark.skipif(not os.path.exists(PSL_FILE), reason="no public suffix list file")
def test_registered_domain_psl_file(spark):
    full = read_suffix_rules(spark, PSL_FILE)
    assert full.n_keys > 7000 and full.max_depth == 4
    assert _domains(spark, full) == HOSTS
    with_private = read_suffix_rules(spark, PSL_FILE, private=True)
    df = spark.createDataFrame([("s3.amazonaws.com",)], "h string")
    assert registered_domain(df, "h", with_private).first()["domain"] is None


def test_registered_only_drops_unregistered(spark, rules):
    df = spark.createDataFrame([(1, "www.example.com"), (2, "localhost")], "i int, h string")
    assert registered_only(df, "h", rules, keep=("i",)).collect() == [(1, "example.com")]


def test_lenient_host(spark):
    got = one_col(spark, ["HTTP://A.B.com:1/x", " x.org ", "u@h.net", "a.b.c.", "a。b"],
                  lenient_host)
    assert got == ["a.b.com", "x.org", "h.net", "a.b.c", "a.b"]


def test_site_label(spark):
    got = one_col(spark, ["www.example.com", "wwf.org", "bbc.co.uk", "example.com:8080",
                          "localhost", ""], site_label)
    assert got == ["example", "", "co", "example", "", ""]


def test_tokens(spark):
    df = spark.createDataFrame([("example", "/a-b/c_d.html", "q=1&r=x y")], "l string, p string, q string")
    assert df.select(url_tokens(F.col("l"), F.col("p"), F.col("q"))).first()[0] == \
        ["example", "a", "b", "c", "d", "html", "q", "1", "r", "x", "y"]


def test_noise_words(spark):
    dropped = ["2024", "page1", "2form", "v2", "wwsite", "ab", "a",
               "0123456789abcdef0123456789abcdef", "a" * 40, "f" * 64]
    kept = ["mp3player", "cat", "abc", "a" * 33]
    got = one_col(spark, dropped + kept, is_noise_word)
    assert got == [True] * len(dropped) + [False] * len(kept)


@pytest.mark.skipif(not os.path.exists(PSL_FILE), reason="no public suffix list file")
def test_large_rule_sets_stay_distributed(spark, monkeypatch):
    from weblex.sources import suffixes
    monkeypatch.setattr(suffixes, "MAX_LOCAL_RULES", 100)
    big = read_suffix_rules(spark, PSL_FILE)
    assert not big.local and big.n_keys > 7000 and big.max_depth == 4
    assert _domains(spark, big) == HOSTS
