"""Porter's stemmer (extended rules, or those of 1980) as a chain of SQL CASE expressions over a column ``w``.

The same rule tables as ``porter`` (the Python stemmer), written as one SQL
expression per step.  Spark runs the chain over the distinct vocabulary
(JVM-side, whole-stage codegen); DuckDB runs it in the correctness oracle.
Only the spelling of two functions differs between the dialects.

Regex reading of the word shape (C = consonant run, V = vowel run; a
leading 'y' is upper-cased first so it reads as a consonant):
    m > 0   ^(C)?VC          m > 1   ^(C)?VCVC        m = 1   ^(C)?VC(V)?$
    *v*     a vowel, or 'y' after a non-vowel
    *d      a doubled consonant (digits count as consonants)
    *o      (with m = 1) the whole stem is C, one vowel, one consonant not w/x/y
Each step picks the longest matching suffix (CASE arms ordered by length)
and leaves the word unchanged if that suffix's condition fails.
"""

from __future__ import annotations

from .porter import IRREGULAR, STEP2, STEP2_EXTENDED, STEP3, STEP4

_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
M_GT0 = f"^(?:{_C})?{_V}{_C}"
M_GT1 = f"^(?:{_C})?{_V}{_C}{_V}{_C}"
M_EQ1 = f"^(?:{_C})?{_V}{_C}(?:{_V})?$"
CVC_M1 = f"^{_C}[aeiouy][^aeiouwxy]$"
#: The extended *o: also a vowel and a consonant alone.
CVC_M1_EXTENDED = CVC_M1 + "|^[aeiou][^aeiou]$"
ENDS_CONSONANT = "[^aeiouy]$|[aeiou]y$|[^aeiouy]yy$"
HAS_V = "[aeiou]|[^aeiou]y"
DOUBLE = "(?:" + "|".join(c * 2 for c in "bcdfghjklmnpqrstvwxz0123456789") + "|[^aeiouy]yy)$"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


class _Dialect:
    def __init__(self, name: str):
        self.name = name

    def match(self, s: str, rx: str) -> str:
        if self.name == "spark":
            return f"({s} RLIKE {_q(rx)})"
        return f"regexp_matches({s}, {_q(rx)})"

    def ends(self, w: str, suffix: str) -> str:
        fn = "endswith" if self.name == "spark" else "ends_with"
        return f"{fn}({w}, {_q(suffix)})"


def _cut(k: int, w: str = "w") -> str:
    return f"left({w}, length({w}) - {k})"


def _replace_step(d: _Dialect, table, cond_rx: str) -> str:
    arms = []
    for suf, rep in sorted(table, key=lambda t: -len(t[0])):
        stem = _cut(len(suf))
        arms.append(f"WHEN {d.ends('w', suf)} THEN CASE WHEN {d.match(stem, cond_rx)} "
                    f"THEN {stem} || {_q(rep)} ELSE w END")
    return "CASE " + " ".join(arms) + " ELSE w END"


def porter_steps(dialect: str, word: str = "word", extended: bool = True) -> tuple[str, list[str], str]:
    """(initial w from ``word``, step expressions w -> w, final term).

    Apply the initial expression, then each step in order (each reads the
    previous ``w``), then the final expression (reads ``word`` and ``w``).
    """
    d = _Dialect(dialect)
    cvc = CVC_M1_EXTENDED if extended else CVC_M1
    init = f"regexp_replace({word}, '^y', 'Y')"
    steps = []
    four = f"WHEN {d.ends('w', 'ies')} AND length(w) = 4 THEN {_cut(1)} " if extended else ""
    steps.append(f"CASE {four}WHEN {d.ends('w', 'sses')} THEN {_cut(2)} "
                 f"WHEN {d.ends('w', 'ies')} THEN {_cut(2)} "
                 f"WHEN {d.ends('w', 'ss')} THEN w "
                 f"WHEN {d.ends('w', 's')} THEN {_cut(1)} ELSE w END")
    ied = (f"WHEN {d.ends('w', 'ied')} THEN CASE WHEN length(w) = 4 THEN {_cut(1)} ELSE {_cut(2)} END "
           if extended else "")
    steps.append(f"CASE {ied}WHEN {d.ends('w', 'eed')} THEN CASE WHEN {d.match(_cut(3), M_GT0)} "
                 f"THEN {_cut(1)} ELSE w END "
                 f"WHEN {d.ends('w', 'ing')} THEN CASE WHEN {d.match(_cut(3), HAS_V)} "
                 f"THEN {_cut(3)} || '~' ELSE w END "
                 f"WHEN {d.ends('w', 'ed')} THEN CASE WHEN {d.match(_cut(2), HAS_V)} "
                 f"THEN {_cut(2)} || '~' ELSE w END ELSE w END")
    s = _cut(1)
    steps.append(f"CASE WHEN {d.ends('w', '~')} THEN CASE "
                 f"WHEN {d.match(s, '(?:at|bl|iz)$')} THEN {s} || 'e' "
                 f"WHEN {d.match(s, DOUBLE)} AND NOT {d.match(s, '[lsz]$')} THEN {_cut(1, s)} "
                 f"WHEN {d.match(s, M_EQ1)} AND {d.match(s, cvc)} THEN {s} || 'e' "
                 f"ELSE {s} END ELSE w END")
    to_i = (f"length(w) > 2 AND {d.match(_cut(1), ENDS_CONSONANT)}" if extended
            else d.match(_cut(1), HAS_V))
    steps.append(f"CASE WHEN {d.ends('w', 'y')} AND {to_i} THEN {_cut(1)} || 'i' ELSE w END")
    if extended:
        steps.append(f"CASE WHEN {d.ends('w', 'alli')} AND {d.match(_cut(4), M_GT0)} THEN {_cut(2)} ELSE w END")
        steps.append(f"CASE WHEN {d.ends('w', 'logi')} THEN CASE WHEN {d.match(_cut(3), M_GT0)} "
                     f"THEN {_cut(1)} ELSE w END ELSE {_replace_step(d, STEP2_EXTENDED, M_GT0)} END")
    else:
        steps.append(_replace_step(d, STEP2, M_GT0))
    steps.append(_replace_step(d, STEP3, M_GT0))
    arms = []
    for suf in sorted(STEP4, key=len, reverse=True):
        stem = _cut(len(suf))
        cond = d.match(stem, M_GT1)
        if suf == "ion":
            cond += f" AND {d.match(stem, '[st]$')}"
        arms.append(f"WHEN {d.ends('w', suf)} THEN CASE WHEN {cond} THEN {stem} ELSE w END")
    steps.append("CASE " + " ".join(arms) + " ELSE w END")
    s = _cut(1)
    steps.append(f"CASE WHEN {d.ends('w', 'e')} AND ({d.match(s, M_GT1)} OR "
                 f"({d.match(s, M_EQ1)} AND NOT {d.match(s, cvc)})) THEN {s} ELSE w END")
    steps.append(f"CASE WHEN {d.ends('w', 'll')} AND {d.match('w', M_GT1)} THEN {_cut(1)} ELSE w END")
    known = " ".join(f"WHEN {word} = {_q(a)} THEN {_q(b)}" for a, b in IRREGULAR.items()) if extended else ""
    final = f"CASE {known} WHEN length({word}) <= 2 THEN {word} ELSE lower(w) END"
    return init, steps, final
