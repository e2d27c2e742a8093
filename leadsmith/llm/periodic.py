"""Periodic runs of words by an online sparse diagonal DP.

A run is a stretch of consecutive words with smallest period q (words q apart are equal),
at least ``LEAST`` words and ``TIMES`` periods long, that no neighbouring word extends.

Every position of the word sequence has its earlier occurrences; each of them lies on a
diagonal (a lag), and a match on a diagonal that matched at the position before makes its
match length one longer.  A diagonal that does not go on is closed: if it is long enough, its
run is emitted at once.  The diagonals are kept sparse by two facts:

* a run matches on its diagonal over at least 2q words, and over at least 16 of them.  So for
  lags up to G (16, 32, 64, ...) a position counts as the G words that start at it, and only
  positions whose G words are found again take part.  G-word names come from pairs of names of
  half the length (exact, no hashes).
* at such a position at most one lag in (G/2, G] belongs to a run with that smallest period:
  the nearest earlier occurrence.  (If a nearer one at distance d existed, G words and d more
  would have both periods, and so their greatest common divisor; the run's smallest period
  would be d or less.)

So a text of n words costs O(n log n), also one word repeated a million times.

Each text is worked on whole in one Arrow pass without a shuffle; a row is a task's smallest
piece of work.  Defined results: a null or empty text has no words and no run; a null id plants
no repetition (``planted``); repeated rows each get the same answer; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadsmith.llm.common import row_by_row

#: Shortest run in words, and in periods.
LEAST, TIMES = 24, 3
#: Words that stand for a position when lags of at most as many words are followed.
GRAM = 16
SCHEMA = ("n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def repeated_grams(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(G, positions, names) for G = 16, 32, ...: positions whose G words are found more than once, equal names for equal words."""
    at, names, size, whole = np.arange(len(codes)), codes, 1, np.empty(len(codes), np.int64)
    while len(at) > 1:
        if size >= GRAM:
            yield size, at, names
        whole.fill(-1)
        whole[at] = names
        at = at[at + size < len(codes)]
        second = whole[at + size]
        at, second = at[second >= 0], second[second >= 0]
        key = whole[at] * (int(names.max()) + 1) + second
        _, names, times = np.unique(key, return_inverse=True, return_counts=True)
        again = times[names] > 1
        at, names, size = at[again], names[again], 2 * size


def nearest_lags(at: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Distance of every position to the nearest earlier one of the same name (0: none)."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    lag = np.zeros(len(at), np.int64)
    lag[order[1:][same]] = (at[order[1:]] - at[order[:-1]])[same]
    return lag


def runs(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of numbers, by start, then period."""
    if least < 24 or times < 3:
        raise ValueError("the 16-word windows serve runs of 24 or more words and 3 or more periods")
    found = []
    for size, at, names in repeated_grams(codes):
        lowest = 0 if size == GRAM else size // 2
        if times * (lowest + 1) > len(codes):
            break
        lags = nearest_lags(at, names)
        own = (lags > lowest) & (lags <= size)
        # the online pass over what is left: the open diagonal, its first and its last matching position
        lag = first = last = -1
        for here, q in zip(at[own].tolist(), lags[own].tolist()):
            if q == lag and here == last + 1:
                last = here
                continue
            if lag > 0 and last + size - first + lag >= max(least, times * lag):
                found.append((first - lag, last + size - first + lag, lag))
            lag, first, last = q, here, here
        if lag > 0 and last + size - first + lag >= max(least, times * lag):
            found.append((first - lag, last + size - first + lag, lag))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(n: int, doc_id: str | None) -> np.ndarray:
    """Which original word stands at each place: rows whose id's crc32 ends in 0 repeat a stretch up to their end."""
    source = np.arange(n)
    h = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    if n and h % 10 == 0:
        g = h // 10
        a = g % n
        source[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return source


def measure(text: str | None, doc_id: str | None, plant: bool) -> tuple:
    """One row of ``SCHEMA``."""
    words = (text or "").encode("utf-8", "surrogatepass").split()  # bytes.split(): ASCII white space alone
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    source = planted(len(words), doc_id) if plant else np.arange(len(words))
    found = runs(codes[source])
    listed = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
    if not found:
        own = words if not plant else [words[i] for i in source.tolist()]
        return len(words), 0, None, None, None, None, listed, hashlib.sha256(b" ".join(own)).hexdigest()
    keep = np.ones(len(words), bool)
    for s, n, q in found:
        keep[s + q:s + n] = False
    s, n, q = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
    left = hashlib.sha256(b" ".join([words[i] for i in source[keep].tolist()])).hexdigest()
    return len(words), len(found), s, n, q, 1000 * n // q, listed, left


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """doc_id, n_words, n_runs, the run of greatest length/period, digests of all runs and of the words left without the repeats.

    ``plant`` first repeats a stretch of every row chosen by its id (a test of the operator on known repetitions)."""
    def run(b: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame([measure(t, i, plant) for i, t in zip(b["i"], b["t"])], columns=[c.split()[0] for c in SCHEMA.split(", ")])
        return out.astype({c: "Int64" for c in ("start", "length", "period", "exponent_milli")})
    ids = docs.select(F.col(id_col).cast("long").alias("id"), F.col(id_col).cast("long").cast("string").alias("name"), F.col(text_col).alias("text"))
    return row_by_row(ids, {"i": "name", "t": "text"}, run, SCHEMA, ["id"]).withColumnRenamed("_row_id", "doc_id").select(
        "doc_id", *[c.split()[0] for c in SCHEMA.split(", ") if c != "n_words long"], "n_words")
