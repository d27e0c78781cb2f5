"""Vector bin packing of token sequences.

Examples have three sizes: tokens, segments (one each) and loss-bearing
tokens; a sequence limits all three.  The dot-product heuristic fills one
sequence at a time: of the examples that fit, take the one whose sizes (as
shares of the limits) have the largest inner product with the room left, ties
to the earlier example.  Where cutting is allowed (plain documents), whole
sequences are cut off long examples first, and a gap that no example fits is
filled with a piece of the longest one left.  Plain documents have no limit on
segments unless one is given; without it only the last sequence of a task has
padding, with it those that reach it, too.  Instruction examples are never
cut, one that exceeds a limit alone is refused.

Each task packs its own rows, GROUP examples or GROUP_TOKENS tokens at a time,
carrying what the last open sequence holds into the next group: no shuffle,
bounded memory.

Defined results: a null text is an empty one; an empty text still has the end
id; repeated rows are packed each; an empty table gives no pieces; columns
other than those named are not read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import release
from .tokens import encoder, slices

TOKENS = 2048
#: No limit on segments.
ANY_SEGMENTS = 1 << 40
GROUP, GROUP_TOKENS = 2048, 1 << 20
END_ID = 1


def fill(sizes: np.ndarray, limits: np.ndarray, cut: bool = False) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (example, first token, tokens).

    ``sizes``: a row (tokens, loss-bearing tokens) per example, at least one
    token; ``limits``: (tokens, segments, loss-bearing tokens).  With ``cut``
    every token bears loss alike and an example may be cut anywhere."""
    left = np.asarray(sizes, np.int64).reshape(-1, 2).copy()
    start = np.zeros(len(left), np.int64)
    limits = np.asarray(limits, np.int64)
    most = int(min(limits[0], limits[2])) if cut else 0
    out: list[list[tuple[int, int, int]]] = []
    if cut:
        for i in np.flatnonzero(left[:, 0] >= most):
            while left[i, 0] >= most:
                out.append([(int(i), int(start[i]), most)])
                start[i] += most
                left[i] -= most
    elif ((left[:, 0] > limits[0]) | (left[:, 1] > limits[2])).any():
        raise ValueError("an example alone exceeds a limit")
    alive = np.flatnonzero(left[:, 0] > 0)
    alive = alive[np.argsort(-left[alive, 0], kind="stable")]
    tokens, loss = left[alive, 0], left[alive, 1]
    share = np.stack([tokens / limits[0], np.full(len(alive), 1 / limits[1]), loss / limits[2]], axis=1)
    open_ = np.ones(len(alive), bool)
    while open_.any():
        room, held = limits.copy(), []
        while room[1] > 0:
            fits = open_ & (tokens <= room[0]) & (loss <= room[2])
            if fits.any():
                gain = np.where(fits, share @ (room / limits), -1.0)
                j = int(gain.argmax())
                held.append((int(alive[j]), int(start[alive[j]]), int(tokens[j])))
                room -= (tokens[j], 1, loss[j])
                open_[j] = False
                continue
            gap = int(min(room[0], room[2]))
            if cut and gap > 0 and open_.any():
                j = int(np.where(open_, tokens, -1).argmax())
                held.append((int(alive[j]), int(start[alive[j]]), gap))
                start[alive[j]] += gap
                tokens[j] -= gap
                loss[j] -= gap
                share[j] = (tokens[j] / limits[0], 1 / limits[1], loss[j] / limits[2])
            break
        out.append(held)
    return out


def _packer(path: str, limits: tuple[int, int, int], key_type, batches):
    enc = encoder(path)
    base, number = TaskContext.get().partitionId() << 40, 0
    waiting: list[list] = []  # [key, first token, ids, tokens of the document]
    names = ["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def flush(last: bool):
        nonlocal number, waiting
        if not waiting:
            return None
        sizes = np.array([[len(w[2])] * 2 for w in waiting])
        packed = fill(sizes, np.array(limits), cut=True)
        rest, rows = [], [[] for _ in names]
        for k, held in enumerate(packed):
            if not last and k == len(packed) - 1 and sum(h[2] for h in held) < min(limits[0], limits[2]):
                rest = [[waiting[i][0], waiting[i][1] + a, waiting[i][2][a:a + n].copy(), waiting[i][3]]
                        for i, a, n in held]
                break
            at = 0
            for i, a, n in held:
                key, start, ids, total = waiting[i]
                for col, x in zip(rows, (key, start + a, n, total, base + number, at, ids[a:a + n].tobytes())):
                    col.append(x)
                at += n
            number += 1
        waiting = rest
        kinds = [key_type, *[pa.int64()] * 5, pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(rows, kinds)], names=names)

    held = 0
    for batch in batches:
        for i, n in slices(batch.column(1)):
            counts, ids = enc.ids(batch.column(1).slice(i, n))
            whole = np.full(len(ids) + n, END_ID, "<u4")
            whole[np.arange(len(ids)) + np.repeat(np.arange(n), counts)] = ids
            ends = np.cumsum(counts + 1).tolist()
            for key, a, b in zip(batch.column(0).slice(i, n).to_pylist(), [0, *ends], ends):
                waiting.append([key, 0, whole[a:b], b - a])
                held += b - a
                if len(waiting) >= GROUP or held >= GROUP_TOKENS:
                    yield flush(False)
                    held = sum(len(w[2]) for w in waiting)
        release()
    done = flush(True)
    if done is not None:
        yield done
    release()


def pack_documents(docs: DataFrame, path: str, tokens: int = TOKENS, segments: int | None = None,
                   loss: int | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: the id, ``start`` and ``length`` in the document's
    ids (its text's, then END_ID), ``doc_tokens``, ``sequence_id``, ``offset``
    in the sequence, ``ids`` (little-endian unsigned 32-bit).  Every token
    bears loss."""
    ship_package(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("key"), F.col(text).alias("text"))
    kind = src.schema["key"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    run = partial(_packer, path, (tokens, segments or ANY_SEGMENTS, loss or tokens), to_arrow_type(kind))
    return src.mapInArrow(run, f"key {kind.simpleString()}, start long, length long, doc_tokens long, "
                               "sequence_id long, offset long, ids binary").withColumnRenamed("key", id_col)


def pack_examples(examples: DataFrame, tokens: int, segments: int, loss: int, id_col: str = "example_id",
                  token_col: str = "n_tokens", loss_col: str = "n_loss") -> DataFrame:
    """Instruction examples, whole: (id, sequence_id, offset, n_tokens, n_loss).
    Null sizes count as 0; an example without tokens takes one segment."""
    ship_package(examples.sparkSession)
    kind = examples.schema[id_col].dataType.simpleString()
    limits = np.array([tokens, segments, loss])

    def run(frames):
        import pandas as pd
        base, number, rest = TaskContext.get().partitionId() << 40, 0, None

        def flush(frame, last):
            nonlocal number
            sizes = frame[["n_tokens", "n_loss"]].to_numpy(np.int64)
            packed = fill(np.maximum(sizes, [1, 0]), limits)
            held = None if last or not packed else [i for i, _, _ in packed.pop()]
            rows = []
            for seq in packed:
                at = 0
                for i, _, _ in seq:
                    rows.append((frame["key"].iat[i], base + number, at, sizes[i, 0], sizes[i, 1]))
                    at += sizes[i, 0]
                number += 1
            out = pd.DataFrame(rows, columns=["key", "sequence_id", "offset", "n_tokens", "n_loss"])
            return out, frame.iloc[held] if held is not None else None

        for frame in frames:
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            while len(rest) >= GROUP:
                out, kept = flush(rest.iloc[:GROUP].reset_index(drop=True), False)
                yield out
                rest = pd.concat([kept, rest.iloc[GROUP:]], ignore_index=True)
        if rest is not None and len(rest):
            yield flush(rest.reset_index(drop=True), True)[0]

    src = examples.select(F.col(id_col).alias("key"), F.coalesce(F.col(token_col), F.lit(0)).cast("long").alias("n_tokens"),
                          F.coalesce(F.col(loss_col), F.lit(0)).cast("long").alias("n_loss"))
    return src.mapInPandas(run, f"key {kind}, sequence_id long, offset long, n_tokens long, n_loss long") \
              .withColumnRenamed("key", id_col)
