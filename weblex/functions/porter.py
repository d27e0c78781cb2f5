"""Porter's suffix-stripping stemmer: the extended rules in common use
(default), or the 1980 paper's.

The extended rules add a table of irregular words, keep ``ie`` in four-letter
words (ties, tied), turn ``ied`` into ``i``, turn a final ``y`` into ``i`` only
after a consonant that isn't the first letter, add ``bli``, ``fulli`` and ``logi``
to step 2, run step 2 again after ``alli``, and count a two-letter
vowel-consonant stem as *o.

A word is read as [C](VC){m}[V]: C a run of consonants, V a run of vowels.
'y' is a consonant at the start of a word or after a vowel, a vowel after a
consonant; digits count as consonants.  Each step applies the rule with the
longest matching suffix only; if that rule's condition fails the step does
nothing.  Words of one or two characters are returned unchanged.

Used per distinct vocabulary word (see ``operators.stemming``), never per
occurrence.
"""

from __future__ import annotations

from functools import lru_cache

_VOWELS = frozenset("aeiou")


def _consonants(w: str) -> list[bool]:
    out: list[bool] = []
    for i, ch in enumerate(w):
        if ch in _VOWELS:
            out.append(False)
        elif ch == "y":
            out.append(i == 0 or not out[i - 1])
        else:
            out.append(True)
    return out


def measure(stem: str) -> int:
    """m: the number of VC sequences in the stem."""
    cons = _consonants(stem)
    m = 0
    for i in range(1, len(cons)):
        if cons[i] and not cons[i - 1]:
            m += 1
    return m


def has_vowel(stem: str) -> bool:
    return not all(_consonants(stem))


def ends_double_consonant(stem: str) -> bool:
    return len(stem) >= 2 and stem[-1] == stem[-2] and _consonants(stem)[-1]


def ends_cvc(stem: str, extended: bool = False) -> bool:
    """*o: ends consonant-vowel-consonant, last one not w, x or y; extended:
    or is vowel-consonant."""
    c = _consonants(stem)
    if extended and len(stem) == 2:
        return not c[0] and c[1]
    if len(stem) < 3:
        return False
    return c[-3] and not c[-2] and c[-1] and stem[-1] not in "wxy"


def _m_gt0(s: str) -> bool:
    return measure(s) > 0


def _m_gt1(s: str) -> bool:
    return measure(s) > 1


# Rule tables of the paper: (suffix, replacement).  Conditions per step.
STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
         ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"),
         ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
         ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
         ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
         ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
         "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


# Fixed values of the extended rules.
STEP2_EXTENDED = [t for t in STEP2 if t[0] != "abli"] + [("bli", "ble"), ("fulli", "ful")]
IRREGULAR = {"sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
             "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
             "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
             "exceed": "exceed", "succeed": "succeed"}


def _longest(word: str, suffixes) -> str | None:
    best = None
    for s in suffixes:
        if word.endswith(s) and (best is None or len(s) > len(best)):
            best = s
    return best


def _step1a(w: str, extended: bool) -> str:
    if extended and len(w) == 4 and w.endswith("ies"):
        return w[:-1]
    suf = _longest(w, ("sses", "ies", "ss", "s"))
    if suf == "sses":
        return w[:-2]
    if suf == "ies":
        return w[:-2]
    if suf == "s":
        return w[:-1]
    return w


def _step1b(w: str, extended: bool) -> str:
    if extended and w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    suf = _longest(w, ("eed", "ed", "ing"))
    if suf is None:
        return w
    stem = w[: -len(suf)]
    if suf == "eed":
        return w[:-1] if _m_gt0(stem) else w
    if not has_vowel(stem):
        return w
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if ends_double_consonant(stem) and stem[-1] not in "lsz":
        return stem[:-1]
    if measure(stem) == 1 and ends_cvc(stem, extended):
        return stem + "e"
    return stem


def _step1c(w: str, extended: bool) -> str:
    if extended:
        if len(w) > 2 and w.endswith("y") and _consonants(w)[-2]:
            return w[:-1] + "i"
        return w
    if w.endswith("y") and has_vowel(w[:-1]):
        return w[:-1] + "i"
    return w


def _replace_step(w: str, table) -> str:
    suf = _longest(w, [s for s, _ in table])
    if suf is None:
        return w
    stem = w[: -len(suf)]
    return stem + dict(table)[suf] if _m_gt0(stem) else w


def _step2(w: str, extended: bool) -> str:
    if not extended:
        return _replace_step(w, STEP2)
    if w.endswith("alli") and _m_gt0(w[:-4]):
        w = w[:-2]
    if w.endswith("logi"):
        return w[:-1] if _m_gt0(w[:-3]) else w
    return _replace_step(w, STEP2_EXTENDED)


def _step4(w: str) -> str:
    suf = _longest(w, STEP4)
    if suf is None:
        return w
    stem = w[: -len(suf)]
    if not _m_gt1(stem):
        return w
    if suf == "ion" and not stem.endswith(("s", "t")):
        return w
    return stem


def _step5(w: str, extended: bool) -> str:
    if w.endswith("e"):
        stem = w[:-1]
        m = measure(stem)
        if m > 1 or (m == 1 and not ends_cvc(stem, extended)):
            w = stem
    if w.endswith("ll") and measure(w) > 1:
        w = w[:-1]
    return w


@lru_cache(maxsize=65536)
def stem(word: str, extended: bool = True) -> str:
    """Stem one lower-case word."""
    if extended and word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    w = _step1a(word, extended)
    w = _step1b(w, extended)
    w = _step1c(w, extended)
    w = _step2(w, extended)
    w = _replace_step(w, STEP3)
    w = _step4(w)
    return _step5(w, extended)
