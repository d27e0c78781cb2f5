"""The Python stemmer against fixed words and against the SQL regex
chain used by the oracle (DuckDB), on random and real words."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from weblex.functions.lexicon import ENGLISH_STOPWORDS, URL_STOPWORDS, default_stopwords
from weblex.functions.porter import measure, stem
from weblex.plans import oracle as O

KNOWN = {
    "running": "run", "generalizations": "gener", "categories": "categori", "sky": "sky",
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl",
    "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss",
    "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "relational": "relat", "conditional": "condit", "rational": "ration",
    "valenci": "valenc", "digitizer": "digit", "conformabli": "conform",
    "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis",
    "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electriciti": "electr",
    "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv",
    "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens",
    "irritant": "irrit", "replacement": "replac", "adjustment": "adjust",
    "dependent": "depend", "adoption": "adopt", "homologou": "homolog",
    "communism": "commun", "activate": "activ", "angulariti": "angular",
    "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control",
    "roll": "roll", "a": "a", "is": "is", "mp3player": "mp3player",
}


# The published extended rules.
EXTENDED = {
    "news": "news", "enjoy": "enjoy", "survey": "survey", "display": "display", "technology": "technolog",
    "biology": "biolog", "possibly": "possibl", "ties": "tie", "dies": "die", "tied": "tie", "innings": "inning",
    "proceed": "proceed", "skies": "sky", "dying": "die", "happy": "happi", "fly": "fli", "by": "by", "say": "say",
    "cries": "cri", "cried": "cri", "using": "use", "use": "use", "sensationally": "sensat", "wonderfully": "wonder",
    "equally": "equal", "running": "run", "relational": "relat", "logi": "logi", "ally": "alli", "owed": "owe",
    "generalizations": "gener", "categories": "categori", "controlled": "control", "apology": "apolog",
}


def test_known_words():
    assert {w: stem(w, False) for w in KNOWN} == KNOWN
    assert {w: stem(w) for w in EXTENDED} == EXTENDED


def test_measure():
    assert [measure(w) for w in ["tr", "ee", "tree", "y", "by"]] == [0, 0, 0, 0, 0]
    assert [measure(w) for w in ["trouble", "oats", "trees", "ivy"]] == [1, 1, 1, 1]
    assert [measure(w) for w in ["troubles", "private", "oaten", "orrery"]] == [2, 2, 2, 2]


def _sql_stems(words):
    con = duckdb.connect()
    con.execute("CREATE TABLE w(word VARCHAR)")
    con.executemany("INSERT INTO w VALUES (?)", [(x,) for x in words])
    sql = O.with_ctes(O.porter_ctes("w"), "SELECT word, term FROM stemmed")
    return dict(con.execute(sql).fetchall())


def test_oracle_sql_matches_known():
    assert _sql_stems(list(EXTENDED)) == EXTENDED


def test_spark_chain_matches_known(spark):
    from weblex.operators.stemming import stem_dictionary
    for known, extended in ((KNOWN, False), (EXTENDED, True)):
        df = spark.createDataFrame([(w,) for w in known], "word string")
        assert dict(stem_dictionary(df, "word", 1, extended=extended).collect()) == known


def test_noise_regex_equals_its_conditions():
    import random
    import re

    from weblex.functions.lexicon import NOISE_WORD_RE
    rng = random.Random(8)
    con = duckdb.connect()
    words = {"".join(rng.choices("0129abcdefwvz", k=rng.choice([1, 2, 3, 4, 6, 31, 32, 33, 40, 64]))) for _ in range(4000)}
    words |= {"page1", "2form", "v2", "wwsite", "ab", "mp3player", "cat", "a" * 32}
    con.execute("CREATE TABLE w AS SELECT unnest($1) AS word", [sorted(words)])
    got = dict(con.execute(f"SELECT word, {O.noise_sql('word')} FROM w").fetchall())
    assert got == {w: re.search(NOISE_WORD_RE, w) is not None for w in words}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="abcdeilmnorstuvyz0123", min_size=1, max_size=14),
                min_size=1, max_size=200))
def test_python_matches_sql_chain(words):
    # Runs of y, whose reading alternates, are left out.
    words = [w for w in set(words) if "yy" not in w]
    if words:
        assert _sql_stems(words) == {w: stem(w) for w in words}


def test_stopword_lists():
    assert len(ENGLISH_STOPWORDS) == 179
    assert len(URL_STOPWORDS) == 104
    assert len(default_stopwords()) == len(set(ENGLISH_STOPWORDS) | set(URL_STOPWORDS))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="abcdeilmnorstuvyz0123", min_size=1, max_size=14),
                min_size=1, max_size=300))
def test_spark_chain_matches_python(spark, words):
    from weblex.operators.stemming import stem_dictionary
    words = sorted(set(words))
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = dict(stem_dictionary(df, "word", 1).collect())
    assert got == {w: stem(w) for w in words}


def test_spark_methods_agree_on_documents(spark):
    from pyspark.sql import functions as F
    from weblex.operators.stemming import stem_dictionary
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z0-9]+")).alias("word")) \
        .filter(F.col("word") != "")
    sql = dict(stem_dictionary(words, "word", 3).collect())
    py = dict(stem_dictionary(words, "word", 3, method="python").collect())
    assert sql == py and len(sql) > 1000
