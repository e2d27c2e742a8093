"""Language identification by nearest centroid over TF-IDF character n-grams.

A text is lower-cased, every run of non-letters becomes one space, and its 2- and
3-grams of code points are hashed into ``DIMENSIONS`` counts.  With IDF weights and unit
length, each language's learning texts are grouped by spherical k-means into several
centroids.  A text gets the language of the centroid with the highest cosine and is
*rejected* when its cosine distance to that centroid is beyond the centroid's radius.

Learning uses a bounded sample: at most ``per_language`` ids of every language, those with
the smallest hash in each slice of ids (documented parameter; document frequencies come
from the same rows).  Every language gets centroids, however many there are; each is fitted
in a task of its own.  Everything else runs over all rows and whole texts, in one Arrow
pass for each ``LANGUAGES_AT_ONCE`` languages.

Defined results: a null text or one without a letter is ``und`` with score 0 and is
rejected; with no learning rows at all every text is ``und``; repeated rows each get the
same answer; ties go to the language first in alphabetical order; extra columns are
ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadsmith.llm.common import blocks, row_by_row, staged

DIMENSIONS = 1 << 14
#: Learning rows of each language, the same number from every one of ``SLICES`` slices of the id hash.
PER_LANGUAGE = 2000
#: Slices keep each window's limit at most 1,000, so Spark cuts every task's rows to it before the shuffle.
SLICES = 4
#: Centroids of each language.
CENTROIDS = 4
#: Languages whose centroids are broadcast and scored at once; more are scored block after block.
LANGUAGES_AT_ONCE = 200
#: Pairs of id and language of the learning sample that are broadcast; a larger sample is joined with a shuffle.
MOST_BROADCAST = 400_000
#: Code points worked on at once.
AT_ONCE = 1 << 20
#: Texts held as dense vectors at once, in learning and in scoring.
DENSE_AT_ONCE = 128
#: A text is rejected if its cosine is below this share of what nearly all learning texts of the centroid reach.
SLACK = 0.3
MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(sys.maxunicode + 1)), bool)


def counts(text: str | None) -> np.ndarray | None:
    """Hashed counts of 2- and 3-grams, or None for a text without a letter."""
    total, seen, tail = np.zeros(DIMENSIONS, np.int64), False, np.array([32], np.uint32)
    text = (text or "").lower()
    for at in range(0, len(text), AT_ONCE):
        c = np.frombuffer(text[at:at + AT_ONCE].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[c]
        seen |= bool(letter.any())
        c = np.concatenate([tail, np.where(letter, c, np.uint32(32))])
        c = c[np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]]  # a run of spaces is one
        two = c[:-1] * MULTIPLIERS[0] ^ c[1:] * MULTIPLIERS[1]
        if len(tail) == 1 and len(two):
            total += np.bincount((two * MULTIPLIERS[2]) >> 18, minlength=DIMENSIONS)
        elif len(two) > 1:
            total += np.bincount((two[1:] * MULTIPLIERS[2]) >> 18, minlength=DIMENSIONS)
        three = two[:-1] * MULTIPLIERS[1] ^ c[2:] * MULTIPLIERS[2]
        if len(three):
            total += np.bincount((three * MULTIPLIERS[0]) >> 18, minlength=DIMENSIONS)
        tail = c[-2:]
    return total if seen else None


def sparse(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Dimensions with a count and their counts, in the types that learning rows are kept in."""
    x = counts(text)
    if x is None:
        return None
    at = np.flatnonzero(x)
    return at.astype(np.uint16), x[at].astype(np.uint32)


def weighted(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values at the dimensions ``at``, of unit length together."""
    v = np.log1p(n.astype(np.float32)) * idf[at]
    return v / np.maximum(np.linalg.norm(v), np.float32(1e-12))


def dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
    """The sparse rows as dense ones, DENSE_AT_ONCE at a time."""
    for part in blocks(rows, DENSE_AT_ONCE):
        x = np.zeros((len(part), DIMENSIONS), np.float32)
        for own, (at, v) in zip(x, part):
            own[at] = v
        yield x


def cosines(rows: list[tuple[np.ndarray, np.ndarray]], centroids: np.ndarray) -> np.ndarray:
    return np.concatenate([x @ centroids.T for x in dense(rows)])


def _unit(c: np.ndarray) -> np.ndarray:
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def spherical_kmeans(rows: list[tuple[np.ndarray, np.ndarray]], k: int, rounds: int = 10) -> np.ndarray:
    """At most k unit centroids of sparse unit rows; the first is the mean, each next starts at the row farthest from all so far."""
    c = sum(x.sum(axis=0, keepdims=True, dtype=np.float64) for x in dense(rows)) / len(rows)
    for _ in range(min(k, len(rows)) - 1):
        far = int(cosines(rows, c).max(axis=1).argmin())
        c = np.concatenate([c, next(dense(rows[far:far + 1]))])
    for _ in range(rounds):
        c, sums, sizes = _unit(c), np.zeros(c.shape), np.zeros(len(c))
        for x in dense(rows):
            own = x @ c.T
            own = (own.argmax(axis=1) == np.arange(len(c))[:, None]).astype(np.float32)  # sums by a product: no copy of the rows
            sums += own @ x
            sizes += own.sum(axis=1)
        c = sums[sizes > 0] / sizes[sizes > 0][:, None]
    return _unit(c)


def sample(docs: DataFrame, label_col: str, id_col: str, per_language: int) -> DataFrame:
    """At most ``per_language`` ids of each language, those with the smallest hash of every slice, with all their rows."""
    w = Window.partitionBy("l", "s").orderBy(F.xxhash64("i"), "i")
    keyed = (docs.select(F.col(id_col).alias("i"), F.col(label_col).alias("l"), F.col("text"))
             .where("i is not null and l is not null and text is not null"))
    picked = (keyed.select("i", "l", F.pmod(F.xxhash64("i", F.lit(1)), F.lit(SLICES)).alias("s"))
              .withColumn("n", F.row_number().over(w)).where(F.col("n") <= per_language // SLICES).select("i", "l").distinct())
    picked = staged(picked, "language-sample")
    # a sample of moderate size is broadcast, so the texts are not shuffled; one of very many languages is joined like any table
    return keyed.join(F.broadcast(picked) if picked.count() <= MOST_BROADCAST else picked, ["i", "l"], "left_semi")


def fit(learn: DataFrame, label_col: str = "lang", id_col: str = "doc_id", per_language: int = PER_LANGUAGE,
        k: int = CENTROIDS) -> dict:
    """Model from a bounded sample of every language: IDF, the sorted languages, and a staged table of their centroids and radii."""
    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            c = [sparse(t) for t in b["text"]]
            yield pd.DataFrame({"i": b["i"], "l": b["l"], "at": [x and x[0].tobytes() for x in c], "n": [x and x[1].tobytes() for x in c]})
    # an id that is repeated counts once, so the rows gathered below are at most per_language a language
    rows = staged(sample(learn, label_col, id_col, per_language).mapInPandas(featured, "i long, l string, at binary, n binary")
                  .where("at is not null").groupBy("i", "l").agg(F.min(F.struct("at", "n")).alias("m")).select("i", "l", "m.*"), "language-learn")

    def texts_with(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros(DIMENSIONS, np.int64)
        for b in batches:
            for at in b["at"]:
                own[np.frombuffer(at, np.uint16)] += 1
        found = np.flatnonzero(own)
        yield pd.DataFrame({"d": found, "c": own[found]})
    texts = np.zeros(DIMENSIONS)
    for r in rows.select("at").mapInPandas(texts_with, "d int, c long").groupBy("d").agg(F.sum("c").alias("c")).collect():
        texts[r["d"]] = r["c"]
    idf = np.log((1 + rows.count()) / (1 + texts)).astype(np.float32) + 1

    def fitted(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["i", "at", "n"])
        at = [np.frombuffer(a, np.uint16) for a in own["at"]]
        x = [(a, weighted(a, np.frombuffer(n, np.uint32), idf)) for a, n in zip(at, own["n"])]
        c = spherical_kmeans(x, k).astype(np.float32)
        cos = cosines(x, c)
        near = cos.argmax(axis=1)
        reached = [cos[near == j, j] for j in range(len(c))]
        return pd.DataFrame({"lang": own["l"].iloc[0], "j": range(len(c)), "reach": [float(np.quantile(r, 0.01)) if len(r) else 1.0 for r in reached],
                             "vector": [v.tobytes() for v in c]})
    table = staged(rows.groupBy("l").applyInPandas(fitted, "lang string, j int, reach double, vector binary"), "language-model")
    return {"idf": idf, "langs": [r["lang"] for r in table.select("lang").distinct().orderBy("lang").collect()], "table": table}


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", slack: float = SLACK, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """doc_id, lang_pred, score, distance, rejected per row, and the columns ``keep`` as _row_<name>; no shuffle.

    The centroids of ``LANGUAGES_AT_ONCE`` languages are broadcast; with more, the rows and their best centroid so far are
    staged after each block of languages, so that one block at a time is held."""
    sc, langs, idf = docs.sparkSession.sparkContext, model["langs"], model["idf"]
    carry, text = ["_row__id", *[f"_row_{c}" for c in keep]], "_row_text" if "text" in keep else "_text"
    now = docs.select(F.col(id_col).cast("long").alias("_row__id"), *[docs[c].alias(f"_row_{c}") for c in keep],
                      *([] if "text" in keep else [F.col("text").alias("_text")]),
                      F.lit("und").alias("lang_pred"), F.lit(-1.0).alias("cos"), F.lit(0.0).alias("reach"))
    for block in list(blocks(langs, LANGUAGES_AT_ONCE)) or [[]]:
        own = model["table"].where(F.col("lang").between(block[0], block[-1])).orderBy("lang", "j").collect() if block else []
        shared = sc.broadcast((idf, [r["lang"] for r in own], np.array([r["reach"] for r in own]),
                               np.stack([np.frombuffer(r["vector"], np.float32) for r in own]) if own else None))
        del own

        def run(part: pd.DataFrame, shared=shared) -> pd.DataFrame:
            idf, names, reach, centroids = shared.value
            lang, best_cos, best_reach = part["lang"].to_numpy(object).copy(), part["cos"].to_numpy().copy(), part["reach"].to_numpy().copy()
            c = [sparse(t) for t in part["t"]]
            known = np.flatnonzero([x is not None for x in c]) if names else np.zeros(0, int)
            if len(known):
                cos = cosines([(c[i][0], weighted(*c[i], idf)) for i in known], centroids)
                best = cos.argmax(axis=1)
                top = np.clip(cos[np.arange(len(cos)), best].astype(float), 0, 1)
                more = top > best_cos[known]  # a tie stays with the language before
                at, best = known[more], best[more]
                lang[at], best_cos[at], best_reach[at] = np.array(names, object)[best], top[more], reach[best]
            return pd.DataFrame({"lang_pred": lang, "cos": best_cos, "reach": best_reach})
        if block and block[0] != langs[0]:
            now = staged(now, "language-scores")
        last = not block or block[-1] == langs[-1]
        by = carry if last or text in carry else [*carry, text]
        done = row_by_row(now, {"t": text, "lang": "lang_pred", "cos": "cos", "reach": "reach"}, run, "lang_pred string, cos double, reach double", by)
        now = done.select(*[F.col(f"_row_{c}").alias(c) for c in by], "lang_pred", "cos", "reach")
    score = F.greatest(F.lit(0.0), F.col("cos"))
    return now.select(F.col("_row__id").alias("doc_id"), "lang_pred", score.alias("score"), (1 - score).alias("distance"),
                      ((F.col("cos") < 0) | (F.col("cos") < slack * F.col("reach"))).alias("rejected"), *[f"_row_{c}" for c in keep])


def fold(id_col: str = "doc_id", folds: int = 4) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def identify(docs: DataFrame, held_out_fold: int = 2, folds: int = 4, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Learn from the other folds of ``docs`` and predict every row; the columns ``keep`` come along as _row_<name>."""
    learn = docs.where(fold(folds=folds) != held_out_fold)
    out = predict(docs, fit(learn), keep=keep)
    return out.select("doc_id", F.coalesce(fold(folds=folds) == held_out_fold, F.lit(False)).alias("held_out"),
                      "lang_pred", "score", "distance", "rejected", *[f"_row_{c}" for c in keep])
