"""Repair of conversation structure with an audit of the edits.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles.  Rows
are kept (K), given another role (R), deleted (D), and empty turns inserted
(I); the cheapest edits win, ties by the ASCII-least audit, the string of
their initials.  A dynamic programme runs over the rows with one entry for
each of four states (nothing yet, after s, after u, after a).

Audits are persistent: a prefix of edits is a linked node that longer audits
share, with its length, a rolling hash and ancestors at distances of powers of
two.  A tie is settled by a search for the longest common prefix: ancestors
are compared by hash from the largest distance down, then the first differing
edits decide.  Equal hashes are proof only if the nodes are the same; others
are verified edit by edit.  Audits of equal cost over the same rows never are
prefixes of one another (what the longer one has besides would cost), so the
least prefix stays the least.

A conversation's rows meet in one task, sorted by Spark (which spills), and
are read once: an entry carries the running SHA-256 of its repaired rows, so
no texts are held, only a few small nodes and a digest a row.  A conversation
is one row of the result, with an edit a row in its audit and one sequential
hash, so its rows cannot be dealt to several tasks.

Defined results: null roles and texts read as one space, null conversation ids
are one conversation, null turns come first; rows of the same turn are taken by
role, then text; a role that starts with none of s, u, a (an empty or null one
too) is never kept; conversations left without rows have zeros; an empty table
gives an empty table; columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import ship_package
from .common import SLICE_ROWS

DELETE, INSERT, RETAIN, REROLE = "D", "I", "K", "R"
COST_DELETE, COST_INSERT, COST_REROLE, COST_TRUNCATED = 2, 5, 1, 5
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: State after a role's initial, by the state before.
FOLLOWS = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = {"su", "ua", "au"}
MODULUS = (1 << 61) - 1
BASE = 1_000_003

_NOT_BLANK = re.compile(r"[^\x20\x09-\x0D]")
_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


class Audits:
    """A forest of edit prefixes; node 0 is the empty audit."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.edit, self.depth, self.hash, self.up = [""], [0], [0], [[]]
        self.verified = 0

    def add(self, parent: int, edit: str) -> int:
        ups, at, k = [parent], parent, 0
        while len(self.up[at]) > k:
            at = self.up[at][k]
            ups.append(at)
            k += 1
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * BASE + ord(edit)) % self.modulus)
        self.up.append(ups)
        return len(self.edit) - 1

    def drop_last(self) -> None:
        for part in (self.edit, self.depth, self.hash, self.up):
            part.pop()

    def ancestor(self, node: int, depth: int) -> int:
        while (over := self.depth[node] - depth) > 0:
            node = self.up[node][over.bit_length() - 1]
        return node

    def common(self, a: int, b: int) -> int:
        """Length of the longest common prefix."""
        depth = min(self.depth[a], self.depth[b])
        a, b = self.ancestor(a, depth), self.ancestor(b, depth)
        if self._same(a, b):
            return depth
        # The parents of the first differing edits are the last equal nodes.
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and not self._same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.depth[a] - 1

    def _same(self, a: int, b: int) -> bool:
        """Whether two prefixes of one length are equal; equal hashes of
        different nodes are verified down to the node they share."""
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            self.verified += 1
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        n = self.common(a, b)
        if n == self.depth[a] or n == self.depth[b]:
            return self.depth[a] < self.depth[b]
        return self.edit[self.ancestor(a, n + 1)] < self.edit[self.ancestor(b, n + 1)]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(out))


def _emitted(digest, first: bool, role: str, text: str):
    out = digest.copy()
    out.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
    return out


class Repair:
    """The programme over one conversation's rows, in order."""

    def __init__(self):
        self.audits = Audits()
        # state -> (cost, audit, running hash of the repaired rows)
        self.best = {EMPTY: (0, 0, hashlib.sha256())}
        self.seen: set[bytes] = set()
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.turn = None
        self.initial = None

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None:
            if turn != self.turn:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.turn = self.high = turn
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        size = len(role.encode("utf-8", "surrogatepass"))
        digest = hashlib.blake2b(f"{size}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        again = digest in self.seen
        self.seen.add(digest)
        if _NOT_BLANK.search(text) is None:
            self.blank += 1
            fault = "blank"
        elif again:
            self.duplicate += 1
            fault = "duplicate"
        elif text.rstrip(_BLANKS)[-1] not in ".!?":
            self.truncated += 1
            fault = "truncated"
        else:
            fault = ""
        self.rows += 1
        self._insert()
        self._edit(role, initial, text, fault)

    def _take(self, table: dict, state: int, cost: int, parent: int, edit: str, made) -> None:
        """Enter an edit for ``state`` if it is cheaper or, at the same cost, less."""
        now = table.get(state)
        if now is not None and (cost > now[0]):
            return
        node = self.audits.add(parent, edit)
        if now is not None and cost == now[0] and not self.audits.less(node, now[1]):
            self.audits.drop_last()
            return
        table[state] = (cost, node, made)

    def _insert(self) -> None:
        """Turns may be inserted here: a user's, then an assistant's (a third
        would come back to a state at a higher cost)."""
        for role, states, to in (("user", (EMPTY, SYSTEM, ASSISTANT), USER), ("assistant", (USER,), ASSISTANT)):
            found = {to: self.best[to]} if to in self.best else {}
            for state in states:
                if state in self.best:
                    cost, audit, made = self.best[state]
                    self._take(found, to, cost + COST_INSERT, audit, INSERT, (made, state == EMPTY, role, ""))
            self._settle(found)
            self.best.update(found)

    def _edit(self, role: str, initial: str, text: str, fault: str) -> None:
        found: dict = {}
        must = fault in ("blank", "duplicate")
        extra = COST_TRUNCATED if fault == "truncated" else 0
        for state, (cost, audit, made) in self.best.items():
            self._take(found, state, cost + COST_DELETE, audit, DELETE, made)
            if must:
                continue
            to = FOLLOWS.get(initial, {}).get(state)
            if to is not None:
                self._take(found, to, cost + extra, audit, RETAIN, (made, state == EMPTY, role, text))
            new = "assistant" if state == USER else "user"
            self._take(found, FOLLOWS[new[0]][state], cost + extra + COST_REROLE, audit, REROLE,
                       (made, state == EMPTY, new, text))
        self._settle(found)
        self.best = found

    @staticmethod
    def _settle(found: dict) -> None:
        """Hash the rows that the winners emit."""
        for state, (cost, audit, made) in found.items():
            if isinstance(made, tuple):
                found[state] = (cost, audit, _emitted(*made))

    def result(self) -> tuple:
        self._insert()
        ends = [self.best[s] for s in (EMPTY, ASSISTANT) if s in self.best]
        cost, audit, made = ends[0]
        for c, a, m in ends[1:]:
            if c < cost or c == cost and self.audits.less(a, audit):
                cost, audit, made = c, a, m
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, self.audits.text(audit),
                made.hexdigest())


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, " \
         "repaired_sha256 string"


def _repairer(key_type, batches):
    names = ["key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = [key_type, *[pa.int64()] * 6, pa.string(), pa.string()]
    now, key, started, out = None, None, False, []

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for i in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(i, SLICE_ROWS)
            for k, turn, role, text, gone in zip(*(c.to_pylist() for c in part.columns)):
                if not started or k != key:
                    if started:
                        out.append((key, *now.result()))
                    now, key, started = Repair(), k, True
                if not gone:
                    now.add(turn, role, text)
            if len(out) >= SLICE_ROWS:
                yield batch_of(out)
                out = []
    if started:
        out.append((key, *now.result()))
    if out:
        yield batch_of(out)


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role: str = "role", text: str = "text",
           gone: Column | None = None) -> DataFrame:
    """A row per conversation: its id, ``gaps`` in the turns, numbers of rows
    by first fault, ``illegal`` neighbours, the repair's ``cost`` and
    ``audit``, and the hash of the repaired ``role:text`` lines.  Rows marked
    ``gone`` only make their conversation known."""
    ship_package(rows.sparkSession)
    absent = F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))
    src = rows.select(F.col(id_col).alias("key"), F.col(turn_col).cast("long").alias("turn"),
                      F.when(~absent, F.coalesce(role, F.lit(" "))).alias("role"),
                      F.when(~absent, F.coalesce(text, F.lit(" "))).alias("text"), absent.alias("gone"))
    kind = src.schema["key"].dataType

    def run(batches, key_type=to_arrow_type(kind)):
        return _repairer(key_type, batches)

    together = src.repartition("key").sortWithinPartitions("key", F.col("turn").asc_nulls_first(), "role", "text")
    return together.mapInArrow(run, f"key {kind.simpleString()}, {RESULT}").withColumnRenamed("key", id_col)


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` rows damaged by crc32(conv_id:turn) % 20: 0 marks the
    row ``gone``, 1 empties its text, 2 takes its sentence ends away, 3 repeats
    it, 4 gives it the role user.  Nulls read as one space."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return (rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("_kind"))
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"), (F.col("_kind") == 0).alias("gone"),
                    F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1)))
                              .otherwise(F.array(F.lit(0)))).alias("_copy"))
            .drop("_copy"))
