"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of ASCII letters and digits and of non-ASCII bytes of the lower-cased UTF-8
text.  A text's features are the distinct hashes of its words, its pairs of neighbours and
its pairs with one word between (``BITS`` bits).  Per-coordinate rates and the L1 term leave
few weights that are not zero; only those are broadcast (at most 2**BITS of them).

Learning takes a bounded sample: of the ``most_rows`` labelled rows with the smallest hash of
their id those, in the order of that hash, whose feature rows together have at most
``most_bytes`` bytes (both documented parameters).  It runs in one task over these feature
rows; scoring is one Arrow pass over all rows and whole texts.

Defined results: a null or empty text is scored by the bias alone; labels other than 0 and 1
and null labels are not learned from; without learning rows every score is 0.5 (predicted 1 by
its definition); repeated rows each get the same score; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadsmith.llm.common import staged
from leadsmith.llm.language import fold

BITS = 20
#: Labelled rows learned from, at most.
MOST_ROWS = 20_000
#: Bytes of their feature rows (4 a feature, so at most 4 MiB a row), at most; the task that learns holds them all.
MOST_BYTES = 1 << 28
#: Bytes of text worked on at once.
AT_ONCE = 1 << 20
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 4.0, 1.0, 4
#: A toxic row counts as many times as there are other rows for each toxic one, at most this.
MOST_WEIGHT = 8.0
ODD = 0x9E3779B97F4A7C15


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.zeros(256, bool)
    inside[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
    powers = np.cumprod(np.full(AT_ONCE + 1, ODD, np.uint64)) * np.uint64(pow(ODD, -1, 1 << 64))
    back = np.cumprod(np.full(AT_ONCE + 1, pow(ODD, -1, 1 << 64), np.uint64)) * np.uint64(ODD)
    return inside, powers, back


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash per word of at most AT_ONCE lower-cased bytes, by prefix sums of a polynomial."""
    inside, powers, back = _tables()
    b = np.frombuffer(raw, np.uint8)
    edge = np.diff(np.concatenate([[0], inside[b].view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers[:len(b)])])
    return _mixed((sums[end] - sums[start]) * back[start])


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    found, carry, at = [], np.empty(0, np.uint64), 0
    while at < len(raw):
        end = min(len(raw), at + AT_ONCE)
        if end < len(raw):  # cut between words where there is a space
            end = max(raw.rfind(b" ", at, end), at) + 1 if raw.rfind(b" ", at, end) > at else end
        h = np.concatenate([carry, word_hashes(raw[at:end])])
        pair = _mixed(h[:-1] * np.uint64(3) + h[1:])
        skip = _mixed(h[:-2] * np.uint64(5) + h[2:])
        found.append(np.unique(np.concatenate([h, pair, skip]) >> np.uint64(64 - BITS)))
        carry, at = h[-2:], end
    return np.unique(np.concatenate(found)).astype(np.int32) if found else np.empty(0, np.int32)


class Ftrl:
    """FTRL-proximal over binary features; coordinate 2**BITS is the bias."""

    def __init__(self):
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, label: int, weight: float) -> None:
        w = self.weights(at)
        g = (_sigmoid(w.sum()) - label) * (weight if label else 1.0)
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - step * w
        self.n[at] += g * g


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", most_rows: int = MOST_ROWS,
        most_bytes: int = MOST_BYTES) -> tuple:
    """(feature numbers, weights): the weights that are not zero."""
    y = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).cast("long").alias("i")).agg(F.max(label_col).cast("int").alias("y"))
    picked = y.where("i is not null").orderBy(F.xxhash64("i"), "i").limit(most_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col("text").alias("t")).join(F.broadcast(picked), "i")  # at most most_rows pairs of numbers

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"i": b["i"], "y": b["y"], "f": [features(t).tobytes() for t in b["t"]]})

    def fitted(r: pd.DataFrame) -> pd.DataFrame:
        r = r.sort_values(["i", "f"])
        found, marks = r["f"].to_numpy(), r["y"].to_numpy()
        order, model = np.random.default_rng(42), Ftrl()
        weight = min(MOST_WEIGHT, (len(r) - r["y"].sum()) / max(1, r["y"].sum()))
        for _ in range(EPOCHS):
            for j in order.permutation(len(r)):
                model.learn(np.append(np.frombuffer(found[j], np.int32), 1 << BITS), marks[j], weight)
        w = model.weights(slice(None))
        at = np.flatnonzero(w)
        return pd.DataFrame({"at": at, "w": w[at]})
    # an id that is repeated counts once, so at most most_rows rows are gathered
    once = staged(rows.mapInPandas(featured, "i long, y int, f binary").groupBy("i", "y").agg(F.min("f").alias("f")), "toxicity-learn")
    upto = F.sum(F.length("f")).over(Window.orderBy(F.xxhash64("i"), "i").rowsBetween(Window.unboundedPreceding, 0))
    room = once.select("i", upto.alias("b")).where(F.col("b") <= most_bytes).select("i")  # numbers of at most most_rows rows
    model = once.join(F.broadcast(room), "i").groupBy().applyInPandas(fitted, "at int, w double").toPandas()
    return model["at"].to_numpy(np.int32), model["w"].to_numpy(np.float32)


def score(docs: DataFrame, model: tuple, id_col: str = "doc_id") -> DataFrame:
    """doc_id, score, predicted per row; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = np.zeros((1 << BITS) + 1, np.float32)
        at, value = shared.value
        w[at] = value
        for b in batches:
            s = np.array([float(_sigmoid(float(w[features(t)].sum(dtype=np.float64)) + w[-1])) for t in b["t"]])
            yield pd.DataFrame({"doc_id": b["i"], "score": s, "predicted": (s >= 0.5).astype(np.int32)})
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col("text").alias("t"))
    return rows.mapInPandas(run, "doc_id long, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, held_out_fold: int = 0, folds: int = 5) -> DataFrame:
    """Learn from the labels of the other folds and score every row of ``docs``."""
    model = fit(docs, labels.where(fold(folds=folds) != held_out_fold))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold(folds=folds) == held_out_fold, F.lit(False)).alias("held_out"), "score", "predicted")
