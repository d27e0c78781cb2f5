"""Exact token counts of whole texts, of any length.

A *stable boundary* of a text is a space that follows a non-space character
and precedes one.  The byte-level pre-tokenizer always starts a new piece
there, whatever stands further left or right, and merges never cross pieces.
Two things rest on it:

* Huge texts are encoded in overlapping windows with offsets.  Two windows
  are spliced at a token start that both have in their overlap and that is a
  stable boundary; without one the overlap is doubled and the window encoded
  again, until it is found or the windows have become one.
* Shorter texts are cut at stable boundaries, all of a slice at once; each
  distinct piece is looked up by number, and new ones are encoded and
  remembered (MEMO_ENTRIES a worker), since words recur.

Tokenizers without that rule (other .json pre-tokenizers, .model files) encode
each text whole.  Defined results: a null text counts as empty (0 tokens); an
empty table gives an empty table; repeated rows are counted row by row; other
columns pass through, those named like a result give way to it.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import annotate, field, text_slices

WINDOW = 16384
OVERLAP = 256
#: Texts over this many characters go window by window.
HUGE = 65536
#: Pieces remembered.
MEMO_ENTRIES = 300_000
#: Pieces encoded in one call of the library.
TOGETHER = 4096
#: Texts cut and looked up at once.
TEXTS, TEXT_BYTES = 1024, 4 << 20
#: Marks that the pre-tokenizer cuts off after a letter or digit: ASCII ones but
#: for the apostrophe, which may start an ending.
MARKS = ".,;:!?\"#$%&()*+-/<=>@[\\]^_`{|}~"
#: Letters of every Unicode version: units of them alone are one pre-token.
LETTERS = "A-Za-z\u00AA\u00B5\u00BA\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u017F"

_CUT = re.compile(r" (?=\S)")
#: Whitespace as str.isspace() has it; texts with a space that is no stable
#: boundary; pieces that are empty or have whitespace at an end.
_WHITE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\p{Z}]"
_LOOSE = f" {_WHITE}|{_WHITE} |^ | $"
_EDGES = f"^$|^{_WHITE}|{_WHITE}$"


def is_stable(text: str, p: int) -> bool:
    """Whether the pre-tokenizer cuts ``text`` before position ``p`` in every
    context."""
    return (0 < p < len(text) - 1 and text[p] == " "
            and not text[p - 1].isspace() and not text[p + 1].isspace())


def stable_pieces(text: str) -> tuple[str, list[str]]:
    """``text`` cut at stable boundaries: what comes before the first, and the
    other pieces without the space each starts with."""
    cuts = [m.start() for m in _CUT.finditer(text) if is_stable(text, m.start())]
    ends = cuts[1:] + [len(text)]
    return text[:cuts[0]] if cuts else text, [text[i + 1:j] for i, j in zip(cuts, ends)]


def _runs(store: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """store[begin:begin + size] of each run, one after the other."""
    here = np.cumsum(sizes) - sizes
    return store[np.repeat(begin - here, sizes) + np.arange(sizes.sum())]


def splice(encode, text: str, window: int = WINDOW, overlap: int = OVERLAP) -> list[int]:
    """Token ids of ``text`` from overlapping windows.

    ``encode(part) -> (ids, starts)`` with the tokens' character starts."""
    out: list[int] = []
    left, n = 0, len(text)
    end = min(n, window)
    ids, starts = encode(text[:end])
    starts = [s for s in starts]
    while end < n:
        wide = overlap
        while True:
            begin = max(left, end - wide)
            to = min(n, begin + max(window, 2 * wide))
            ids2, starts2 = encode(text[begin:to])
            if begin == left:  # the windows have become one
                end, ids, starts = to, ids2, starts2
                break
            mine = set(s + left for s in starts)
            common = [s + begin for s in starts2
                      if s + begin < end - 1 and s + begin in mine and is_stable(text, s + begin)]
            if common:
                p = common[len(common) // 2]
                out += ids[:_first(starts, p - left)]
                k = _first(starts2, p - begin)
                ids, starts = ids2[k:], [s + begin - p for s in starts2[k:]]
                left, end = p, to
                break
            wide *= 2
    return out + ids


def _first(starts: list[int], at: int) -> int:
    lo, hi = 0, len(starts)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid + 1, hi) if starts[mid] < at else (lo, mid)
    return lo


class Encoder:
    """Token ids (as little-endian unsigned 32-bit bytes) of texts."""

    def __init__(self, path: str, window: int = WINDOW, overlap: int = OVERLAP, huge: int = HUGE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.window, self.overlap, self.huge = window, overlap, huge
        # Units met so far, each after a space, and their ids.
        self.units = pa.array([], pa.large_string())
        self.sizes, self.store = np.zeros(0, np.int64), np.zeros(0, "<u4")
        self.specials: dict[str, int] = {}
        self.stable = False
        if path.endswith(".model"):
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self._whole = lambda texts: sp.encode(texts, num_threads=1)
            return
        import json

        from tokenizers import Tokenizer, pre_tokenizers
        tok = Tokenizer.from_file(path)
        self._tok = tok
        self._whole = lambda texts: [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, added = spec.get("pre_tokenizer") or {}, tok.get_added_tokens_decoder()
        plain = all(not (a.lstrip or a.rstrip or a.single_word or a.normalized) for a in added.values())
        self.stable = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                       and not pre.get("add_prefix_space") and not spec.get("normalizer")
                       and len(added) <= 1 and plain)
        if self.stable:
            self.specials = {a.content: i for i, a in added.items()}
            # A byte-level token is spelled with one character a byte.
            self.lengths = np.zeros(max(tok.get_vocab().values()) + 1, np.int64)
            for word, i in tok.get_vocab().items():
                self.lengths[i] = len(word)
            # The same model for pre-tokens spelled already, a line each.
            self._spelled = Tokenizer(tok.model)
            self._spelled.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            self.spelling = np.zeros(256, "<u4")
            for c in filter(re.compile(f"[{LETTERS} ]").match, map(chr, range(0x180))):
                self.spelling[list(c.encode())] = list(map(ord, spell(c)[0][0]))
            self.spelling[ord("\n")] = ord("\n")

    def _with_offsets(self, part: str):
        e = self._tok.encode(part, add_special_tokens=False)
        return e.ids, [s for s, _ in e.offsets]

    def _each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of tokens, ids) of pieces encoded one by one."""
        found = [np.asarray(x, "<u4") for x in self._whole(pieces)] if pieces else []
        return np.fromiter(map(len, found), np.int64, len(found)), np.concatenate([np.zeros(0, "<u4"), *found])

    def _together(self, units: pa.Array, spelled: bool) -> tuple[np.ndarray, np.ndarray]:
        """The same of units that follow a space, many in one text, which is cut
        again by the tokens' byte lengths: no token crosses a stable boundary.
        Units of LETTERS alone may be spelled here, which spares the library
        the search for pre-tokens."""
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, "<u4")]
        offsets = np.append(np.arange(0, len(units), TOGETHER), len(units))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), units)
        joined = pc.binary_join(lists, pa.scalar("\n " if spelled else " ", pa.large_string()))
        lengths = pc.binary_length(units).to_numpy()
        for text, i, j in zip(joined, offsets, offsets[1:]):
            if spelled:
                codes = self.spelling[np.frombuffer(b" " + text.as_buffer().to_pybytes(), np.uint8)]
                line = codes.tobytes().decode("utf-32-le")
                got = self._spelled.encode_batch_fast([line], add_special_tokens=False)[0].ids
            else:
                got = self._whole([". " + text.as_py()])[0]
            got = np.asarray(got, "<u4")
            ends = np.cumsum(np.append(0, self.lengths[got]))
            stops = np.cumsum(np.append(0 if spelled else 1, lengths[i:j] + 1))
            at = np.searchsorted(ends, stops)
            if ends[-1] != stops[-1] or not (ends[at] == stops).all():
                raise ValueError("a token crosses a stable boundary")
            sizes.append(np.diff(at))
            ids.append(got[at[0]:])
        return np.concatenate(sizes), np.concatenate(ids)

    def _remember(self, units: pa.Array) -> np.ndarray:
        """Where the distinct ``units`` are in the memory; the new ones join it.
        A memory that grows too large is cut to the units now asked for."""
        at = pc.index_in(units, value_set=self.units)
        is_new = at.is_null().to_numpy(zero_copy_only=False)
        at = at.fill_null(0).to_numpy().astype(np.int64)
        if not is_new.any():
            return at
        new = units.filter(pa.array(is_new))
        if len(self.units) + len(new) > MEMO_ENTRIES:
            kept = at[~is_new]
            begin = np.cumsum(self.sizes) - self.sizes
            self.store = _runs(self.store, begin[kept], self.sizes[kept])
            self.units, self.sizes = self.units.take(pa.array(kept)), self.sizes[kept]
            at[~is_new] = np.arange(len(kept))
        plain = pc.match_substring_regex(new, f"^[{LETTERS}]+$").to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(new, _EDGES).to_numpy(zero_copy_only=False)
        kinds = [np.flatnonzero(k) for k in (plain, ~plain & ~odd, odd)]
        letters, mixed, alone = (new.take(pa.array(k)) for k in kinds)
        found = [self._together(letters, True), self._together(mixed, False),
                 self._each([" " + w for w in alone.to_pylist()])]
        order = np.concatenate(kinds)
        at[np.flatnonzero(is_new)[order]] = len(self.units) + np.arange(len(order))
        self.units = pa.concat_arrays([self.units, letters, mixed, alone])
        self.sizes = np.concatenate([self.sizes, *[sizes for sizes, _ in found]])
        self.store = np.concatenate([self.store, *[ids for _, ids in found]])
        return at

    def _pieces(self, words: pa.Array, heads: pa.Array, is_head: np.ndarray, whole: bool):
        """(number of tokens of each piece, their ids) where heads, which no
        space precedes, and words, which one does, follow each other.

        A word that ends in marks after a letter or digit is put together from
        the word and the marks (the pre-tokenizer cuts there, too)."""
        words, heads = words.dictionary_encode(), heads.dictionary_encode()
        known = words.dictionary
        core = pc.utf8_rtrim(known, MARKS)
        marked = pc.and_(pc.less(pc.binary_length(core), pc.binary_length(known)),
                         pc.match_substring_regex(core, r"[\p{L}\p{N}]$"))
        units = pc.if_else(marked, core, known).dictionary_encode()
        marks = pc.extract_regex(pc.if_else(marked, known, ""), f"(?P<m>[{re.escape(MARKS)}]*)$").field(0).dictionary_encode()
        unit = self._remember(units.dictionary)[units.indices.to_numpy()]
        head_sizes, head_ids = self._each(heads.dictionary.to_pylist())
        mark_sizes, mark_ids = self._each(marks.dictionary.to_pylist())
        sizes = np.concatenate([self.sizes, head_sizes, mark_sizes])
        # Two numbers a piece: its unit or head, and its marks.
        parts = np.zeros((len(is_head), 2), np.int64)
        code = words.indices.to_numpy()
        parts[~is_head, 0] = unit[code]
        parts[~is_head, 1] = len(self.sizes) + len(head_sizes) + marks.indices.to_numpy()[code]
        parts[is_head, 0] = len(self.sizes) + heads.indices.to_numpy()
        parts[is_head, 1] = len(sizes)
        sizes = np.append(sizes, 0)
        n = sizes[parts]
        if not whole:
            return n.sum(axis=1), None
        store = np.concatenate([self.store, head_ids, mark_ids])
        begin = np.cumsum(sizes) - sizes
        return n.sum(axis=1), _runs(store, begin[parts.ravel()], n.ravel())

    def _cut(self, text: str) -> list[tuple[str, list[str]]]:
        """(head, words) of what stands between special strings."""
        mark = next(iter(self.specials), None)
        return [stable_pieces(part) for part in (text.split(mark) if mark else [text])]

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of tokens of each text (null: empty)."""
        return self._texts(texts, False)[0]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of tokens of each text, all their ids one after the other)."""
        return self._texts(texts, True)

    def _texts(self, texts: pa.Array, whole: bool):
        texts = texts.cast(pa.large_string()).fill_null("")
        if not self.stable:
            sizes, ids = self._each(texts.to_pylist())
            return sizes, ids if whole else None
        huge = pc.greater(pc.utf8_length(texts), self.huge).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, _LOOSE)
        for mark in self.specials:
            odd = pc.or_(odd, pc.match_substring(texts, mark))
        odd = odd.to_numpy(zero_copy_only=False) & ~huge
        # Texts that every space cuts: one head, then words.
        parts = pc.split_pattern(texts.filter(pa.array(~odd & ~huge)), " ")
        at = parts.offsets.to_numpy()
        at, flat = at - at[0], parts.flatten()
        is_head = np.zeros(len(flat), bool)
        is_head[at[:-1]] = True
        words, heads = [flat.filter(pa.array(~is_head))], [flat.filter(pa.array(is_head))]
        ends, heads_of = [at[1:]], [is_head]
        # Others are cut one by one; each special string starts a new head.
        more_words, more_heads, more_is_head, breaks = [], [], [], []
        strange = np.flatnonzero(odd)
        for i in strange.tolist():
            for head, rest in self._cut(texts[i].as_py()):
                more_heads.append(head)
                more_words += rest
                more_is_head += [True, *[False] * len(rest)]
            breaks.append(len(more_is_head))
        if len(strange):
            words.append(pa.array(more_words, pa.large_string()))
            heads.append(pa.array(more_heads, pa.large_string()))
            ends.append(np.array(breaks) + len(flat))
            heads_of.append(np.array(more_is_head))
        is_head, ends = np.concatenate(heads_of), np.concatenate(ends)
        sizes, ids = self._pieces(pa.concat_arrays(words), pa.concat_arrays(heads), is_head, whole)
        if len(strange):
            sizes, ids = self._with_specials(sizes, ids, is_head, np.append(0, ends[:-1]))
        order = np.concatenate([np.flatnonzero(~odd & ~huge), strange])
        total = np.append(0, np.cumsum(sizes))[ends]
        counts = np.zeros(len(texts), np.int64)
        counts[order] = np.diff(total, prepend=0)
        windows = {i: np.asarray(splice(self._with_offsets, texts[i].as_py(), self.window, self.overlap), "<u4")
                   for i in np.flatnonzero(huge).tolist()}
        for i, x in windows.items():
            counts[i] = len(x)
        if not whole or not len(strange) + len(windows):
            return counts, ids
        store = np.concatenate([ids, *windows.values()])
        begin = np.zeros(len(texts), np.int64)
        begin[order] = total - counts[order]
        begin[list(windows)] = len(ids) + np.cumsum([0, *map(len, windows.values())])[:-1]
        return counts, _runs(store, begin, counts)

    def _with_specials(self, sizes, ids, is_head, first):
        """A special string's id before each head but a text's first."""
        inner = is_head.copy()
        inner[first] = False
        if not inner.any():
            return sizes, ids
        if ids is not None:
            ids = np.insert(ids, (np.cumsum(sizes) - sizes)[inner], next(iter(self.specials.values())))
        return sizes + inner, ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit bytes."""
        counts, ids = self.ids(pa.array(list(texts), pa.large_string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])] if len(counts) else []


@lru_cache(maxsize=2)
def encoder(path: str, window: int = WINDOW, overlap: int = OVERLAP, huge: int = HUGE) -> Encoder:
    """One encoder a worker process, so that its memory of pieces lasts."""
    return Encoder(path, window, overlap, huge)


def slices(texts: pa.Array) -> list[tuple[int, int]]:
    return text_slices(texts, TEXTS, TEXT_BYTES)


def _counter(path: str, window: int, overlap: int, huge: int):
    enc = encoder(path, window, overlap, huge)

    def run(texts):
        return pc.binary_length(texts).fill_null(0).cast(pa.int64()), pa.array(enc.counts(texts))
    return run


def count_tokens(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None,
                 window: int = WINDOW, overlap: int = OVERLAP, huge: int = HUGE) -> DataFrame:
    """``docs`` plus ``n_bytes`` and ``n_tokens`` (long) of the whole text.

    ``path``: a tokenizer file present on every worker."""
    return annotate(docs, partial(_counter, path, window, overlap, huge),
                    [field("n_bytes", T.LongType()), field("n_tokens", T.LongType())], text, keep, slices)
