"""Vector bin packing of documents into training sequences by the dot-product heuristic.

A sequence is a bin with three limits at once: tokens, segments and loss-bearing tokens.
Text is encoded with a byte-level vocabulary; every full stretch of ``limit`` tokens is a
sequence of its own, the rest of a document is an item with a demand vector (as shares of
the limits).  For the open bin the item with the largest dot product of demand and room
left, weighted by the mean demand of each dimension, is placed until none fits; then an
item is cut to fill what is left.  Items wait in a pool of bounded size, so bins are chosen
among thousands of items while a task streams over its rows; there is no shuffle.
Sequences that stay short, closed by the limit of segments or of loss or by a task's end,
are cut into powers of two, which need no padding.

Loss-bearing tokens are those after a document's first ``prompt`` tokens (a column of
instruction data; none for plain documents).

Defined results: a null text is empty (its end id only); rows with equal ids are packed
each on its own; a null id stays null; sequence ids are unique, the task's number times
2**40 plus a running number; extra columns are ignored; empty input, no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadsmith.llm.tokens import tokenizer

LIMIT, SEGMENTS, LOSS = 2048, 64, 2048
#: Items that wait for a bin, at most.
POOL = 2048
#: Room under this many tokens is not filled by a cut.
LEAST_CUT = 1
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "loss_tokens long")


class Packer:
    """Places items into sequences; yields finished ones as rows."""

    def __init__(self, task: int, limit: int, segments: int, loss: int, pool: int):
        self.caps = np.array([limit, segments, loss], float)
        self.limit, self.pool, self.number = limit, pool, task << 40
        self.items: list[tuple] = []  # (doc, ids of the whole document, start, length, prompt)

    @staticmethod
    def loss_of(start: int, length: int, prompt: int) -> int:
        return max(0, start + length - max(start, prompt))

    def add(self, doc, ids: np.ndarray, prompt: int) -> Iterator[tuple]:
        at = 0
        while len(ids) - at >= self.limit and self.loss_of(at, self.limit, prompt) <= self.caps[2]:
            yield from self._sequence([(doc, ids, at, self.limit, prompt)])
            at += self.limit
        while at < len(ids):  # a rest of any length, in items that fit a bin alone
            n = min(len(ids) - at, self.limit)
            while self.loss_of(at, n, prompt) > self.caps[2]:
                n -= int(self.loss_of(at, n, prompt) - self.caps[2])
            self.items.append((doc, ids, at, n, prompt))
            at += n

    def _sequence(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, ids, start, n, prompt in pieces:
            yield (doc, start, n, zlib.crc32(ids[start:start + n].tobytes()), len(ids), self.number, offset, self.loss_of(start, n, prompt))
            offset += n
        self.number += 1

    def pack(self, leave: int) -> Iterator[tuple]:
        """Fill sequences until at most ``leave`` items wait, short ones cut into powers of two."""
        if len(self.items) <= leave:
            return
        # one column a dimension, as shares of the limits
        columns = list((np.array([(n, 1, self.loss_of(s, n, p)) for _, _, s, n, p in self.items], float) / self.caps).T.copy())
        items, free = list(self.items), np.ones(len(self.items), bool)
        sums, left = [float(c.sum()) for c in columns], len(items)
        while left > leave:
            room, placed = [1.0] * 3, []
            weight = [x / left for x in sums]
            while left:
                fits = free.copy()
                for c, r in zip(columns, room):
                    fits &= c <= r + 1e-9
                value = sum(c * (w * r) for c, w, r in zip(columns, weight, room))
                best = int(np.where(fits, value, -1.0).argmax())
                if not fits[best]:
                    break
                placed.append(items[best])
                free[best] = False
                left -= 1
                for d, c in enumerate(columns):
                    room[d] -= c[best]
                    sums[d] -= c[best]
            gap = int(round(room[0] * self.caps[0]))
            if gap >= LEAST_CUT and room[1] * self.caps[1] >= 1 - 1e-6 and left:
                j = int(np.where(free, columns[0], -1.0).argmax())  # cut the longest item that waits
                doc, ids, s, n, p = items[j]
                cut = min(gap, n)
                cut -= max(0, self.loss_of(s, cut, p) - int(round(room[2] * self.caps[2])))
                if 0 < cut < n:
                    placed.append((doc, ids, s, cut, p))
                    items[j] = (doc, ids, s + cut, n - cut, p)
                    for d, x in enumerate((n - cut, 1, self.loss_of(s + cut, n - cut, p))):
                        sums[d] += x / self.caps[d] - columns[d][j]
                        columns[d][j] = x / self.caps[d]
            total = sum(x[3] for x in placed)
            if total < self.limit:  # closed by another limit, or the task's last
                yield from self._powers(placed, total)
            else:
                yield from self._sequence(placed)
        self.items = [x for x, f in zip(items, free) if f]

    def _powers(self, pieces: list[tuple], total: int) -> Iterator[tuple]:
        """A short sequence cut into lengths that are powers of two."""
        pieces = list(pieces[::-1])
        while total:
            want, here = 1 << (total.bit_length() - 1), []
            total -= want
            while want:
                doc, ids, s, n, p = pieces.pop()
                take = min(n, want)
                here.append((doc, ids, s, take, p))
                if take < n:
                    pieces.append((doc, ids, s + take, n - take, p))
                want -= take
            yield from self._sequence(here)


def pack(docs: DataFrame, vocabulary: str, limit: int = LIMIT, segments: int = SEGMENTS, loss: int = LOSS, end_id: int = 1,
         pool: int = POOL, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in its sequence."""
    if min(limit, segments, loss) < 1:
        raise ValueError("limits must be at least 1")
    end = int(end_id).to_bytes(4, "little")
    prompt = F.coalesce(F.col(prompt_col).cast("long"), F.lit(0)) if prompt_col else F.lit(0).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"), prompt.alias("p"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        packer, out = Packer(TaskContext.get().partitionId(), limit, segments, loss, pool), []

        def frame():
            f = pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            f["doc_id"] = f["doc_id"].astype("Int64")
            out.clear()
            return f
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at:at + 256]
                for i, p, ids in zip(part["i"], part["p"], tokenizer(vocabulary, "byte_level").encode(list(part["t"]))):
                    out.extend(packer.add(None if pd.isna(i) else int(i), np.frombuffer(ids + end, "<u4"), int(p)))
                if len(packer.items) > pool:
                    out.extend(packer.pack(pool // 2))
                if len(out) > 20_000:
                    yield frame()
        out.extend(packer.pack(0))
        if out:
            yield frame()
    return rows.mapInPandas(run, SCHEMA)
