"""Column expressions over URL strings (all JVM-side, codegen friendly).

Semantics follow Python's ``urllib.parse.urlparse`` for the parts used by the
term analysis and host extraction, and the lenient host reading a suffix
library applies before matching public-suffix rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import NOISE_WORD_RE

# RFC 3986 split: 1 scheme, 2 netloc, 3 path, 4 query (fragment dropped).
# Scheme = ASCII letter, then letters/digits/+-. up to the first ':'.
URL_SPLIT_RE = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:[?]([^#]*))?"

# FIXED VALUES: schemes for which urlparse splits ";params" off the last
# path segment (Python's urllib.parse.uses_params, "" = no scheme).
PARAM_SCHEMES = ["", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp",
                 "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel"]

# Python's \w on a str pattern: Unicode letters, digits, underscore.
_PY_WORD = r"[\p{L}\p{N}_]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c) -> Column:
    """``str.strip()``: drop leading/trailing whitespace (ASCII and Unicode)."""
    return F.regexp_replace(_c(c), r"^[\s\p{Z}\x1c-\x1f\x85]+|[\s\p{Z}\x1c-\x1f\x85]+$", "")


def _clean(url) -> Column:
    # urlsplit removes tab, CR and LF anywhere in the string.
    return F.regexp_replace(_c(url), r"[\t\r\n]", "")


def brackets_balanced(netloc: Column) -> Column:
    """False when the netloc has '[' without ']' or the reverse (ValueError)."""
    has_open = F.instr(netloc, "[") > 0
    has_close = F.instr(netloc, "]") > 0
    return ~((has_open & ~has_close) | (has_close & ~has_open))


def url_parts(url) -> Column:
    """struct<scheme, netloc, path, query, valid>.

    netloc, path and query are lower-cased; ``;params`` of the last path
    segment are removed (only for schemes that use params); the fragment is
    dropped; ``valid`` is false for unbalanced brackets in the netloc.
    """
    u = _clean(url)
    scheme = F.lower(F.regexp_extract(u, URL_SPLIT_RE, 1))
    netloc = F.lower(F.regexp_extract(u, URL_SPLIT_RE, 2))
    raw_path = F.regexp_extract(u, URL_SPLIT_RE, 3)
    path = F.lower(F.when(scheme.isin(PARAM_SCHEMES),
                          F.regexp_replace(raw_path, r";[^/]*$", "")).otherwise(raw_path))
    query = F.lower(F.regexp_extract(u, URL_SPLIT_RE, 4))
    return F.struct(scheme.alias("scheme"), netloc.alias("netloc"), path.alias("path"),
                    query.alias("query"), brackets_balanced(netloc).alias("valid"))


def url_host(url) -> Column:
    """lower(netloc) cut at the first ':'; empty or invalid -> null.

    ``user:pw@host`` therefore yields ``user`` (the cut happens before '@').
    """
    u = _clean(url)
    netloc = F.lower(F.regexp_extract(u, URL_SPLIT_RE, 2))
    host = F.substring_index(netloc, ":", 1)
    return F.when(brackets_balanced(netloc) & (host != ""), host)


def lenient_host(text, stripped: bool = False) -> Column:
    """Host as read before suffix matching; accepts URLs and bare hosts.

    Drop ``scheme://`` (or a leading ``//``), cut at the first ``/?#``, keep
    what follows the last '@', cut at ':', strip blanks and trailing dots,
    map ideographic full stops to '.', lower-case.  A bracketed (IPv6) host
    can never have a registered domain and maps to ''.  ``stripped``: the
    input has no surrounding blanks already.
    """
    t = _c(text) if stripped else strip_text(text)
    # "scheme://" or "//" is dropped only when the text starts with it; the
    # host part ends at the first '/', '?' or '#'.
    t = F.regexp_extract(t, r"^(?:(?:[A-Za-z0-9+.-]+:)?//)?([^/?#]*)", 1)
    t = F.substring_index(t, "@", -1)              # after the last '@'
    t = F.when(t.startswith("["), F.lit("")).otherwise(t)
    t = strip_text(F.substring_index(t, ":", 1))
    t = F.translate(t, "。．｡", "...")
    # Trailing root dots.  SQL rtrim(trimChars, str): characters come first.
    t = F.call_function("rtrim", F.lit("."), t)
    return F.lower(t)


def site_label(netloc) -> Column:
    """Drop a leading ``ww*.`` label, return the second-to-last label.

    ``wwf.org`` -> '' ; ``bbc.co.uk`` -> ``co`` ; the port stays on the last
    label, so ``example.com:8080`` -> ``example``.
    """
    stripped = F.regexp_replace(_c(netloc), "^ww" + _PY_WORD + r"*\.", "")
    parts = F.split(stripped, r"\.")
    return F.when(F.size(parts) > 1, F.try_element_at(parts, F.lit(-2))).otherwise(F.lit(""))


def url_tokens(label, path, query) -> Column:
    """P5: join label/path/query, map [^a-z0-9] to spaces, split on blanks."""
    joined = F.concat_ws(" ", _c(label), _c(path), _c(query))
    spaced = F.trim(F.regexp_replace(joined, "[^a-z0-9]+", " "))
    return F.split(spaced, " ")


def is_noise_word(word) -> Column:
    """true for numbers, ww-words, 1-2 letter words, hex digests, ..."""
    return _c(word).rlike(NOISE_WORD_RE)
