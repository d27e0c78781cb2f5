"""P1/P2 against Python's urllib.parse on random URL-like strings.

Brackets are left out of the alphabet: only unbalanced brackets are
modelled (Python >= 3.11 also validates the address inside them), and the
edge tests cover those.  Strings have no surrounding blanks (lines are
stripped before parsing).
"""

import urllib.parse

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weblex.functions.urls import url_host, url_parts

ALPHABET = "abcXYZ019:/?#@;.-+%=&_ é"
PIECES = st.sampled_from(["http://", "https://", "//", "mailto:", "ftp://", "Ab+c:", "x:", "1a:",
                          "www.", "user:pw@", ":8080", "/", "?", "#", ";", "a.b.co.uk", ""])
URLS = st.lists(st.one_of(PIECES, st.text(alphabet=ALPHABET, min_size=1, max_size=6)),
                min_size=1, max_size=7).map("".join).map(str.strip)


def expected(u):
    try:
        p = urllib.parse.urlparse(u)
    except ValueError:
        return None
    host = p.netloc.lower().split(":")[0]
    return (p.netloc.lower(), p.path.lower(), p.query.lower(), host or None)


@settings(max_examples=10, deadline=None)
@given(st.lists(URLS, min_size=20, max_size=60))
def test_matches_urllib(spark, urls):
    urls = [u for u in dict.fromkeys(urls) if u]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    rows = df.select("u", url_parts(F.col("u")).alias("p"), url_host(F.col("u")).alias("h")).collect()
    for r in rows:
        exp = expected(r.u)
        assert exp is not None
        assert (r.p.netloc, r.p.path, r.p.query, r.h) == exp, r.u
