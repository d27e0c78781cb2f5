"""DuckDB SQL for the correctness oracle.

Each registered query has an SQL twin that DuckDB runs on the same parquet
tables.  The SQL is formulated independently of the Spark plans where it
can be: suffix rules are matched by exploding host suffixes and aggregating
(Spark tests each suffix depth against hash sets), cutoffs use a plain
running-sum window, first-seen order uses struct minima.  Stems come from a
formulation of their own: each step joins the words to a table of suffixes,
takes the longest, and tests conditions on a spelled-out consonant/vowel
shape (Spark runs a chain of regular expressions).  Noise words are tested
one condition at a time.

Builders return SQL text; ``with_ctes`` glues named CTEs into one statement.
"""

from __future__ import annotations

from urllib.parse import uses_params

from ..functions.lexicon import default_stopwords
from ..sources.suffixes import FIXTURE_EXTRA_SUFFIXES, icann_text


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


# ---------------------------------------------------------------- scalars

WS = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"


def strip_sql(e: str) -> str:
    return f"regexp_replace({e}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def clean_sql(e: str) -> str:
    return f"regexp_replace({e}, '[\\t\\r\\n]', '', 'g')"


#: Scheme at the start of a URL.
SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*):"


def _before_query(e: str) -> str:
    return f"split_part(split_part({clean_sql(e)}, '#', 1), '?', 1)"


def _after_scheme(e: str) -> str:
    return f"regexp_replace({_before_query(e)}, {q(SCHEME)}, '')"


def scheme_sql(e: str) -> str:
    return f"lower(regexp_extract({_before_query(e)}, {q(SCHEME)}, 1))"


def netloc_sql(e: str) -> str:
    return f"lower(regexp_extract({_after_scheme(e)}, '^//([^/]*)', 1))"


def path_sql(e: str) -> str:
    schemes = ", ".join(q(s) for s in uses_params)
    raw = f"regexp_replace({_after_scheme(e)}, '^//[^/]*', '')"
    return (f"lower(CASE WHEN {scheme_sql(e)} IN ({schemes}) "
            f"THEN regexp_replace({raw}, ';[^/]*$', '') ELSE {raw} END)")


def query_sql(e: str) -> str:
    return f"lower(substr(split_part({clean_sql(e)}, '#', 1), length({_before_query(e)}) + 2))"


def valid_sql(netloc: str) -> str:
    o, c = f"strpos({netloc}, '[') > 0", f"strpos({netloc}, ']') > 0"
    return f"NOT (({o} AND NOT {c}) OR ({c} AND NOT {o}))"


def host_sql(e: str) -> str:
    n = netloc_sql(e)
    h = f"split_part({n}, ':', 1)"
    return f"CASE WHEN {valid_sql(n)} AND {h} <> '' THEN {h} END"


def lenient_host_sql(e: str) -> str:
    t = strip_sql(e)
    t = f"regexp_replace({t}, '^(?:[A-Za-z0-9+.-]+:)?//', '')"
    t = f"regexp_extract({t}, '^[^/?#]*', 0)"
    t = f"regexp_replace({t}, '^.*@', '')"
    t = f"CASE WHEN starts_with({t}, '[') THEN '' ELSE {t} END"
    t = strip_sql(f"split_part({t}, ':', 1)")
    t = f"translate({t}, '。．｡', '...')"
    t = f"regexp_replace({t}, '[.]+$', '')"
    return f"lower({t})"


def site_label_sql(netloc: str) -> str:
    s = f"string_split(regexp_replace({netloc}, '^ww[\\p{{L}}\\p{{N}}_]*[.]', ''), '.')"
    return f"CASE WHEN len({s}) > 1 THEN {s}[-2] ELSE '' END"


def tokens_sql(label: str, path: str, query: str) -> str:
    j = f"concat_ws(' ', {label}, {path}, {query})"
    return f"string_split(trim(regexp_replace({j}, '[^a-z0-9]+', ' ', 'g')), ' ')"


def noise_sql(w: str) -> str:
    digits = "('0', '1', '2', '3', '4', '5', '6', '7', '8', '9')"
    hexes = f"(length({w}) IN (32, 40, 64) AND translate({w}, '0123456789abcdef', '') = '')"
    return (f"(left({w}, 1) IN {digits} OR right({w}, 1) IN {digits} OR left({w}, 2) = 'ww' "
            f"OR length({w}) <= 2 OR {hexes})")


def stopword_list_sql() -> str:
    return ", ".join(q(w) for w in default_stopwords())


# ------------------------------------------------------------ corpora

def link_urls_sql() -> str:
    """(page_id, pos, url) from pages, as the Spark link corpus."""
    hrefs = """regexp_extract_all(html, 'href="([^"]+)"', 1)"""
    return f"""
SELECT page_id, CAST(pos AS BIGINT) AS pos,
       CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
            WHEN starts_with(href, '//') THEN 'http:' || href
            WHEN starts_with(href, '/') THEN 'http://' || host || href
            ELSE 'http://' || host || '/' || href END AS url
FROM (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
             unnest({hrefs}) AS href,
             unnest(generate_series(0, len({hrefs}) - 1)) AS pos
      FROM pages)"""


# ---------------------------------------------------------- suffix rules

def rule_strings_sql() -> str:
    """(r) the ICANN rules, read by SQL from the text of the packaged list."""
    return (f"SELECT lower(string_split(line, ' ')[1]) AS r FROM (SELECT trim(unnest(string_split("
            f"{q(icann_text())}, chr(10)))) AS line) WHERE line <> '' AND NOT starts_with(line, '//')")


def rules_sql(extra: list[str] | None = None) -> str:
    """Merged rules (key, plain, wild, exc) from raw PSL strings."""
    more = [f"SELECT {q(r)}" for r in (FIXTURE_EXTRA_SUFFIXES if extra is None else extra)]
    return f"""
SELECT key, bool_or(kind = 'n') AS plain, bool_or(kind = 'w') AS wild,
       bool_or(kind = 'x') AS exc
FROM (SELECT CASE WHEN starts_with(r, '*.') THEN substr(r, 3)
                  WHEN starts_with(r, '!') THEN substr(r, 2) ELSE r END AS key,
             CASE WHEN starts_with(r, '*.') THEN 'w'
                  WHEN starts_with(r, '!') THEN 'x' ELSE 'n' END AS kind
      FROM ({" UNION ALL ".join([rule_strings_sql(), *more])}))
WHERE key <> ''
GROUP BY key"""


def registered_ctes(src: str, text_col: str, name: str = "regd") -> list[tuple[str, str]]:
    """CTE ``name(text_col, domain)``: distinct text values and their domain.

    All suffixes of the host are matched at once; the suffix length is the
    exception length if any exception matched, else the longest plain or
    wildcard match.  Needs the ``rules`` CTE.
    """
    h = lenient_host_sql(text_col)
    return [
        (f"{name}_h", f"SELECT txt, string_split(hst, '.') AS labels, len(string_split(hst, '.')) AS n "
                      f"FROM (SELECT DISTINCT {text_col} AS txt, {h} AS hst FROM {src} "
                      f"WHERE {text_col} IS NOT NULL)"),
        (f"{name}_s", f"SELECT txt, k, array_to_string(list_slice(labels, n - k + 1, n), '.') AS key "
                      f"FROM (SELECT txt, labels, n, unnest(generate_series(1, n)) AS k FROM {name}_h)"),
        (f"{name}_l", f"""
SELECT h.txt, h.labels, h.n,
       coalesce(max(CASE WHEN r.exc THEN s.k - 1 END),
                greatest(max(CASE WHEN r.plain THEN s.k END),
                         max(CASE WHEN r.wild AND h.n > s.k THEN s.k + 1 END)),
                0) AS L
FROM {name}_h h
LEFT JOIN {name}_s s ON s.txt = h.txt
LEFT JOIN rules r ON r.key = s.key
GROUP BY h.txt, h.labels, h.n"""),
        (name, f"SELECT txt AS {text_col}, CASE WHEN L >= 1 AND n >= L + 1 AND labels[n - L] <> '' "
               f"THEN array_to_string(list_slice(labels, n - L, n), '.') END AS domain FROM {name}_l"),
    ]


# ------------------------------------------------------------ porter

def shape_sql(w: str) -> str:
    """One letter a character: C consonant, V vowel (y by what precedes it)."""
    e = f"regexp_replace({w}, '[aeiou]', 'V', 'g')"
    e = f"regexp_replace({e}, '[^Vy]', 'C', 'g')"
    e = f"regexp_replace({e}, '^y', 'C')"
    for _ in range(2):
        e = f"regexp_replace(regexp_replace({e}, 'Cy', 'CV', 'g'), 'Vy', 'VC', 'g')"
    return e


def measure_sql(w: str) -> str:
    return f"len(regexp_extract_all({shape_sql(w)}, 'VC'))"


def cvc_sql(w: str) -> str:
    return (f"((ends_with({shape_sql(w)}, 'CVC') AND right({w}, 1) NOT IN ('w', 'x', 'y')) "
            f"OR {shape_sql(w)} = 'VC')")


#: (suffix, replacement) of the steps; fixed values of the stemmer.
PORTER_TABLES = {
    2: "ational ate, tional tion, enci ence, anci ance, izer ize, bli ble, alli al, entli ent, eli e, ousli ous, "
       "ization ize, ation ate, ator ate, alism al, iveness ive, fulness ful, ousness ous, aliti al, iviti ive, "
       "biliti ble, fulli ful, logi log",
    3: "icate ic, ative -, alize al, iciti ic, ical ic, ful -, ness -",
    4: "al -, ance -, ence -, er -, ic -, able -, ible -, ant -, ement -, ment -, ent -, ion -, ou -, ism -, ate -, "
       "iti -, ous -, ive -, ize -",
}
PORTER_IRREGULAR = ("sky sky, skies sky, dying die, lying lie, tying tie, news news, innings inning, inning inning, "
                    "outings outing, outing outing, cannings canning, canning canning, howe howe, "
                    "proceed proceed, exceed exceed, succeed succeed")


def _pairs(text: str) -> str:
    return ", ".join("({}, {})".format(*(q("" if x == "-" else x) for x in p.split())) for p in text.split(", "))


def _suffix_step(src: str, table: int, cond: str) -> str:
    """Replace the longest matching suffix where ``cond`` (on the stem s) holds."""
    return f"""
SELECT word, CASE WHEN suf IS NULL OR NOT ({cond}) THEN w ELSE s || rep END AS w
FROM (SELECT a.word, a.w, r.suf, r.rep, left(a.w, length(a.w) - length(coalesce(r.suf, ''))) AS s,
             row_number() OVER (PARTITION BY a.word ORDER BY coalesce(length(r.suf), 0) DESC) AS pick
      FROM {src} a LEFT JOIN (VALUES {_pairs(PORTER_TABLES[table])}) r(suf, rep) ON ends_with(a.w, r.suf))
WHERE pick = 1"""


def porter_ctes(src: str, word_col: str = "word") -> list[tuple[str, str]]:
    """CTEs ending in ``stemmed(word, term)`` for the words of ``src``."""
    less = lambda k, w="w": f"left({w}, length({w}) - {k})"
    return [
        ("vocab", f"SELECT DISTINCT {word_col} AS word FROM {src}"),
        ("p1a", f"""SELECT word, CASE
            WHEN length(word) = 4 AND ends_with(word, 'ies') THEN {less(1, 'word')}
            WHEN ends_with(word, 'sses') OR ends_with(word, 'ies') THEN {less(2, 'word')}
            WHEN ends_with(word, 's') AND NOT ends_with(word, 'ss') THEN {less(1, 'word')} ELSE word END AS w
            FROM vocab WHERE length(word) > 2"""),
        ("p1b", f"""SELECT word, w, CASE WHEN ends_with(w, 'ied') OR ends_with(w, 'eed') THEN NULL
            WHEN ends_with(w, 'ed') AND contains({shape_sql(less(2))}, 'V') THEN {less(2)}
            WHEN ends_with(w, 'ing') AND contains({shape_sql(less(3))}, 'V') THEN {less(3)} END AS s FROM p1a"""),
        ("p1", f"""SELECT word, CASE
            WHEN ends_with(w, 'ied') THEN CASE WHEN length(w) = 4 THEN {less(1)} ELSE {less(2)} END
            WHEN ends_with(w, 'eed') THEN CASE WHEN {measure_sql(less(3))} > 0 THEN {less(1)} ELSE w END
            WHEN s IS NULL THEN w
            WHEN right(s, 2) IN ('at', 'bl', 'iz') THEN s || 'e'
            WHEN length(s) > 1 AND right(s, 1) = left(right(s, 2), 1) AND ends_with({shape_sql('s')}, 'C')
                THEN CASE WHEN right(s, 1) IN ('l', 's', 'z') THEN s ELSE {less(1, 's')} END
            WHEN {measure_sql('s')} = 1 AND {cvc_sql('s')} THEN s || 'e' ELSE s END AS w FROM p1b"""),
        ("p1c", f"""SELECT word, CASE WHEN ends_with(w, 'y') AND length(w) > 2 AND ends_with({shape_sql(less(1))}, 'C')
            THEN {less(1)} || 'i' ELSE w END AS w FROM p1"""),
        ("p2a", f"""SELECT word, CASE WHEN ends_with(w, 'alli') AND {measure_sql(less(4))} > 0 THEN {less(2)} ELSE w END AS w
            FROM p1c"""),
        ("p2", _suffix_step("p2a", 2, f"{measure_sql("CASE WHEN suf = 'logi' THEN s || 'l' ELSE s END")} > 0")),
        ("p3", _suffix_step("p2", 3, f"{measure_sql('s')} > 0")),
        ("p4", _suffix_step("p3", 4, f"{measure_sql('s')} > 1 AND (suf <> 'ion' OR right(s, 1) IN ('s', 't'))")),
        ("p5a", f"""SELECT word, CASE WHEN ends_with(w, 'e') AND ({measure_sql(less(1))} > 1 OR
            ({measure_sql(less(1))} = 1 AND NOT {cvc_sql(less(1))})) THEN {less(1)} ELSE w END AS w FROM p4"""),
        ("p5", f"""SELECT word, CASE WHEN ends_with(w, 'll') AND {measure_sql('w')} > 1 THEN {less(1)} ELSE w END AS w
            FROM p5a"""),
        ("stemmed", f"""SELECT v.word, coalesce(i.term, p5.w, v.word) AS term FROM vocab v LEFT JOIN p5 ON p5.word = v.word
            LEFT JOIN (VALUES {_pairs(PORTER_IRREGULAR)}) i(word, term) ON i.word = v.word"""),
    ]


# ------------------------------------------------------ term pipeline

def term_ctes(corpus_sql: str, min_len: int = 3, keep: str = "") -> list[tuple[str, str]]:
    """CTEs: corpus, rules, recs (processed URLs), words, stemmed, occ.

    ``occ(keep..., domain, term)`` has one row per kept term occurrence.
    ``keep`` is an optional leading column list (e.g. "page_id, pos, ").
    """
    u = "url"
    ctes = [("corpus", corpus_sql), ("rules", rules_sql())]
    ctes.append(("stripped", f"SELECT {keep}{strip_sql(u)} AS url FROM corpus WHERE url IS NOT NULL"))
    ctes += registered_ctes("stripped", "url")
    ctes.append(("recs", f"SELECT {keep}s.url, r.domain FROM stripped s JOIN regd r ON r.url = s.url "
                         f"WHERE s.url <> '' AND r.domain IS NOT NULL"))
    n = netloc_sql("url")
    toks = tokens_sql(site_label_sql(n), path_sql("url"), query_sql("url"))
    ctes.append(("words", f"SELECT {keep}domain, word FROM (SELECT {keep}domain, unnest({toks}) AS word "
                          f"FROM recs WHERE {valid_sql(n)}) "
                          f"WHERE length(word) >= {min_len} AND NOT {noise_sql('word')} "
                          f"AND word NOT IN ({stopword_list_sql()})"))
    ctes += porter_ctes("words")
    ctes.append(("occ", f"SELECT {keep}w.domain, s.term FROM words w JOIN stemmed s ON s.word = w.word "
                        f"WHERE length(s.term) >= {min_len}"))
    ctes.append(("td", "SELECT term, domain, CAST(count(*) AS BIGINT) AS n FROM occ GROUP BY term, domain"))
    ctes.append(("tc", "SELECT term, CAST(sum(n) AS BIGINT) AS n FROM td GROUP BY term"))
    return ctes


def cutoff_cte(share: float, src: str = "tc") -> tuple[str, str]:
    """kept(term, n): the plain running-sum walk in (n desc, term asc) order."""
    return ("kept", f"""
SELECT term, n FROM (
  SELECT term, n, row_number() OVER (ORDER BY n DESC, term) AS rn,
         sum(n) OVER (ORDER BY n DESC, term ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
         sum(n) OVER () AS tot
  FROM {src}) r
WHERE rn <= (SELECT min(rn) FROM (
  SELECT row_number() OVER (ORDER BY n DESC, term) AS rn,
         sum(n) OVER (ORDER BY n DESC, term ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
         sum(n) OVER () AS tot FROM {src}) x
  WHERE CAST(run AS DOUBLE) / CAST(tot AS DOUBLE) >= {float(share)!r})""")


def top_domains_cte(max_domains: int, src: str = "td", name: str = "top") -> tuple[str, str]:
    return (name, f"""
SELECT term, domain, n, rank FROM (
  SELECT term, domain, n,
         CAST(row_number() OVER (PARTITION BY term ORDER BY n DESC, domain) AS BIGINT) AS rank
  FROM {src}) WHERE rank <= {int(max_domains)}""")


def report_sql(share: float = 0.8, max_domains: int = 1000) -> list[tuple[str, str]]:
    return [cutoff_cte(share),
            ("kept_td", "SELECT td.* FROM td WHERE term IN (SELECT term FROM kept)"),
            top_domains_cte(max_domains, "kept_td"),
            ("lists", "SELECT term, string_agg(domain, ',' ORDER BY rank) AS domains "
                      "FROM top GROUP BY term")]


def term_frequency_sql(corpus_sql: str, share: float = 0.8, max_domains: int = 1000,
                       min_len: int = 3) -> str:
    ctes = term_ctes(corpus_sql, min_len) + report_sql(share, max_domains)
    return with_ctes(ctes, "SELECT k.term, k.n AS frequency, l.domains FROM kept k "
                           "JOIN lists l ON l.term = k.term")
