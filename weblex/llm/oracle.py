"""DuckDB SQL for the queries that SQL can express; written from the contracts,
with the rules, phrases and templates as parameters."""

from __future__ import annotations

import re

from . import licenses, quality

SPACE = r"\x20\x09-\x0D"


def quality_sql() -> str:
    bits = " + ".join(f"(CASE WHEN {cond} THEN {1 << i} ELSE 0 END)" for i, (_, cond) in enumerate(quality.RULES))
    p = quality.POLICIES[quality.DEFAULT_POLICY]

    def rejects(b: str) -> str:
        return f"(({b} & {p.hard}) <> 0 OR bit_count(({b} & {p.soft})::BIGINT) >= {p.soft_limit})"

    freed = " + ".join(f"(CASE WHEN {rejects('fail_bits')} AND (fail_bits & {1 << i}) <> 0 "
                       f"AND NOT {rejects(f'(fail_bits - {1 << i})')} THEN {1 << i} ELSE 0 END)"
                       for i in range(len(quality.RULES)))
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS words,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) AS lines
           FROM documents),
grams AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS g
          FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS i FROM t)),
twice AS (SELECT doc_id, g FROM grams GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + o) AS n
            FROM grams JOIN twice USING (doc_id, g), generate_series(0, 7) AS s(o) GROUP BY doc_id),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(n, 0)::BIGINT AS n_repeat_words,
             length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
             length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::BIGINT AS n_letters
      FROM t LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, ({bits})::BIGINT AS fail_bits,
             (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM m)
SELECT *, (NOT base_failed AND (fail_bits & {p.hard}) = 0 AND bit_count((fail_bits & {p.soft})::BIGINT) < {p.soft_limit}) AS kept,
       ({freed})::BIGINT AS freed_bits, '{p.version}' AS policy FROM b"""


def _template_regex(template: str) -> str:
    out = ""
    for m in re.finditer(r"\[\[|\]\]|\{\{(\d+)\}\}|[^\s\[\]{}]+", template):
        part = m.group(0)
        out += "(" if part == "[[" else ")?" if part == "]]" else "( [^ ]+){0,%s}" % m.group(1) if m.group(1) else " " + part
    return out + " "


def license_sql() -> str:
    spots = " || ".join(
        "list_filter(range(0, len(words)), lambda i: words[i + 1:i + {n}] = [{ws}])".format(
            n=len(p.split()), ws=", ".join(f"'{w}'" for w in p.split())) for p, _ in licenses.PHRASES)
    base = " || ".join(f"(CASE WHEN contains(j, ' {p} ') THEN ['{label}'] ELSE [] END)" for p, label in licenses.PHRASES)
    more = " || ".join(f"(CASE WHEN regexp_matches(j, '{_template_regex(t)}') THEN ['{label}'] ELSE [] END)"
                       for label, t in licenses.TEMPLATES)
    return f"""
WITH t AS (SELECT doc_id, trim(regexp_replace(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g')) AS s FROM documents),
w AS (SELECT doc_id, ' ' || s || ' ' AS j, CASE WHEN s = '' THEN [] ELSE string_split(s, ' ') END AS words FROM t),
p AS (SELECT doc_id, words, {spots} AS spots, {base} AS base, {more} AS more FROM w)
SELECT doc_id, len(words)::BIGINT AS n_words, len(spots)::BIGINT AS n_base,
       list_min(spots)::BIGINT AS first_word, list_max(spots)::BIGINT AS last_word,
       array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(base || more)), ',') AS labels,
       CASE WHEN len(more) > 0 THEN 1.0::DOUBLE WHEN len(base) > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM p"""


def warc_sql() -> str:
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS x,
             min(page_id) OVER (PARTITION BY sha1(html)) AS first FROM p),
q AS (SELECT page_id, payload_bytes, first, list_transform(range(0, 8), lambda i: ('0x' || substr(x, 5 * i + 1, 5))::INTEGER) AS v
      FROM h)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
           substr('{alphabet}', 1 + ((v[i // 4 + 1] >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM q"""


def top_k_sql(k: int = 20, scale: int = 64) -> str:
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""


def divergence_sql(min_docs: int = 10, top: int = 10) -> str:
    share = "(1 + 1000000000::HUGEINT * ({n} + 2) // greatest({size} + 2 * v, 1))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents),
w AS (SELECT d, lang, source, unnest(words) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT d) >= {min_docs}),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(size, 0) AS size, coalesce(v, 0) AS v, coalesce(lang_size, 0) AS lang_size
      FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN (SELECT lang, source, sum(n) AS size FROM c GROUP BY ALL) USING (lang, source)
      LEFT JOIN (SELECT lang, count(*) AS v, sum(total) AS lang_size FROM k GROUP BY lang) USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {share.format(n="coalesce(n, 0)", size="size")} AS p,
             {share.format(n="total", size="lang_size")} AS q
      FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank FROM (
    SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank FROM r)
WHERE part = 'pair' OR rank <= {top}"""


def embedding_sql(threshold: float = 0.93) -> str:
    return f"""
WITH RECURSIVE r AS (SELECT row_number() OVER () AS u, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e
                     FROM embeddings),
v AS (SELECT * FROM r WHERE label IS NOT NULL AND e IS NOT NULL
      AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.u AS a, b.u AS b FROM v a JOIN v b ON a.label = b.label AND a.u <> b.u AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= {threshold}),
reach AS (SELECT u, u AS w FROM r UNION SELECT reach.u, l.b FROM reach JOIN l ON reach.w = l.a),
c AS (SELECT reach.u, min(o.vec_id) AS component_id FROM reach JOIN r o ON o.u = reach.w GROUP BY reach.u),
n AS (SELECT a AS u, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM r JOIN c USING (u) LEFT JOIN n USING (u)"""


def repair_sql() -> str:
    space = r"[^\x20\x09-\x0D]"
    return f"""
WITH RECURSIVE t AS (
    SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::UBIGINT, range(0, 8)::UBIGINT[]),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(0, 256) r(i))),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                            lambda x: ascii(x)::UBIGINT) AS bytes FROM conversations),
k AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes),
          lambda s, b: xor(s >> 8, t[((xor(s, b) & 255) + 1)::BIGINT])), 4294967295) % 20 AS kind FROM c, t),
g AS (SELECT row_number() OVER () AS g, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
d AS (SELECT g, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM k JOIN g ON k.conv_id IS NOT DISTINCT FROM g.conv_id, range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '{space}') THEN 'blank'
                     WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
                     WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
             lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) || left(role, 1) AS pair FROM o),
s AS (SELECT g, count(f.i) AS n, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
             coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
      FROM g LEFT JOIN f USING (g) GROUP BY g),
ins(st, mid, n, more) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 1, 'user:'),
    (1, 2, 1, 'user:'), (3, 2, 1, 'user:'), (2, 3, 1, 'assistant:'), (0, 3, 2, 'user:' || chr(10) || 'assistant:'),
    (1, 3, 2, 'user:' || chr(10) || 'assistant:')),
e(mid, edit, initial, st, name) AS (VALUES (0, 'K', 's', 1, ''), (0, 'K', 'u', 2, ''), (1, 'K', 'u', 2, ''), (3, 'K', 'u', 2, ''),
    (2, 'K', 'a', 3, ''), (0, 'R', NULL, 2, 'user'), (1, 'R', NULL, 2, 'user'), (3, 'R', NULL, 2, 'user'),
    (2, 'R', NULL, 3, 'assistant'), (0, 'D', NULL, 0, ''), (1, 'D', NULL, 1, ''), (2, 'D', NULL, 2, ''), (3, 'D', NULL, 3, '')),
dp AS (
    SELECT g, 0::BIGINT AS i, 0 AS st, 0::BIGINT AS cost, '' AS audit, '' AS made FROM g
    UNION ALL
    SELECT g, i, st, cost, audit, made FROM (
        SELECT *, row_number() OVER (PARTITION BY g, st ORDER BY cost, audit) AS place FROM (
            SELECT dp.g, f.i, e.st,
                   cost + 5 * ins.n + CASE edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
                   + CASE WHEN edit <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS cost,
                   audit || repeat('I', ins.n) || edit AS audit,
                   concat_ws(chr(10), CASE WHEN dp.st > 0 THEN made END, CASE WHEN ins.n > 0 THEN more END,
                             CASE edit WHEN 'K' THEN role || ':' || text WHEN 'R' THEN name || ':' || text END) AS made
            FROM dp JOIN ins ON ins.st = dp.st JOIN f ON f.g = dp.g AND f.i = dp.i + 1
            JOIN e ON e.mid = ins.mid AND (e.initial IS NULL OR e.initial = left(role, 1))
            WHERE edit = 'D' OR fault NOT IN ('blank', 'duplicate'))) WHERE place = 1),
z AS (SELECT g, cost + 5 * ins.n AS cost, audit || repeat('I', ins.n) AS audit,
             concat_ws(chr(10), CASE WHEN dp.st > 0 THEN made END, CASE WHEN ins.n > 0 THEN more END) AS made
      FROM dp JOIN s USING (g) JOIN ins ON ins.st = dp.st WHERE dp.i = s.n AND mid IN (0, 3)),
b AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY cost, audit) AS place FROM z)
SELECT conv_id, gaps::BIGINT AS gaps, blank, duplicate, truncated, illegal, cost::BIGINT AS cost, audit,
       sha256(made) AS repaired_sha256
FROM g JOIN s USING (g) JOIN b USING (g) WHERE place = 1"""
