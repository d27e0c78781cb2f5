"""Word lists and patterns whose values fix the results.

These are data, not logic: changing any entry changes which terms are
counted.  They are kept here, verbatim and in their natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: the English stopword list of the NLTK stopwords corpus
# (179 words, natural order).
# ---------------------------------------------------------------------------
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than
too very s t can will just don don't should should've now d ll m o re ve y ain
aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan
shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# ---------------------------------------------------------------------------
# FIXED VALUES: URL vocabulary treated as stopwords on top of the English
# list (natural order; "page" appears twice in the source list).
# ---------------------------------------------------------------------------
URL_STOPWORDS = """
https http
php html htm aspx asp jsp cfm cgi shtml xhtml
index default home main page tag tags category categories
article articles post posts entry entries comment comments
archive archives search feed rss xml sitemap contact
page id tid pid uid sid cid mid nid itemid userid
view action type format mode sort order limit start
ref source lang language locale version theme template
small medium large thumb thumbnail preview full mini
image img photo pic picture file document doc pdf
video audio mp3 mp4 webm mov avi
content system module component plugin include upload
download print public private admin login user account
""".split()


def default_stopwords() -> list[str]:
    """Distinct stopwords, first-seen order (English list, then URL words)."""
    seen: dict[str, None] = {}
    for w in ENGLISH_STOPWORDS + URL_STOPWORDS:
        seen.setdefault(w, None)
    return list(seen)


# ---------------------------------------------------------------------------
# FIXED VALUES: noise-word test.  A token here is already [a-z0-9]+, so the
# source's twelve "ignore" patterns (pure numbers, dates, ww-prefixes, UUIDs,
# md5/sha1/sha256 hex, word+digits, digits+word, v+digits, letter+digits,
# one or two characters) reduce to this one expression: dates and UUIDs need
# '-', '.' or '/', which a token cannot hold; every digit pattern starts or
# ends with a digit; \w{1,2} is any 1-2 character token.
# Valid for both Java regex (Spark) and RE2 (DuckDB).
# ---------------------------------------------------------------------------
NOISE_WORD_RE = (
    "^[0-9]|[0-9]$|^ww|^.{1,2}$"
    "|^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"
)
