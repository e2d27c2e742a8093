r"""Spelling variants: words one edit apart, found through Bloom filters, grouped under their commonest form.

1. Words are counted in each task before the shuffle; those of at least ``LEAST_LENGTH`` code
   points and ``LEAST_TIMES`` occurrences are the vocabulary.  Every word has a 64-bit key, a
   sum over its code points that gives the key of any edit without writing the edited word.
2. The vocabulary's keys fill blocked Bloom filters, one shard a word length (512-bit blocks;
   words over ``LAST_SHARD`` code points share a shard).  Segments of blocks are built by Spark,
   and at most ``FILTER_BYTES`` of them are broadcast at once: a larger vocabulary is probed in
   several passes, each with the next stretch of blocks, so what is broadcast does not grow.
3. Each word generates its deletions and its replacements by a greater letter (insertions and the
   other replacements are the same pairs from the other side) and probes their keys.
4. Only positives (pairs of keys) are shuffled to an exact join with the vocabulary, which removes
   those that are no word; the words themselves are compared there, so equal keys do no harm.
5. A word's form is its near word with most occurrences, if at least twice its own; forms only
   grow commoner, so pointer doubling reaches the root in a few rounds.

Letters of the edits are those of the vocabulary, at most the ``A-Z a-z U+00C0-U+00FF`` of the
words' pattern.  No word is compared with all others, and there is no limit on neighbours.

Defined results: a null text has no words; a null id changes no word (``misspelt``); rows that
are repeated count again; a word without a near word has n_near 0 and is its own root; extra
columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadsmith.llm.common import staged

LEAST_LENGTH, LEAST_TIMES = 5, 3
#: Occurrences of a form for each of the word's own, at least.
TIMES_COMMONER = 2
RUN = re.compile("[a-zÀ-ÿ]+")
#: Different words a task counts before it passes them on.
COUNTED_AT_ONCE = 200_000
#: Words longer than this share one shard of the filter.
LAST_SHARD = 63
#: A word's room in the filter, the bits set for it, a block's bits, blocks a segment.
BITS_A_WORD, BITS_SET, BLOCK, SEGMENT = 16, 6, 512, 4096
#: Filter bytes broadcast at once.
FILTER_BYTES = 32 << 20
#: Keys of edits that are worked out in one go.
AT_ONCE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of keys (splitmix64's finaliser)."""
    x = x + np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def letters(codes: np.ndarray) -> np.ndarray:
    """The number that stands for a code point in keys."""
    return mixed(codes.astype(np.uint64), 0x5851F42D4C957F2D)


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def by_length(words: list[str], room: int = AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which words, their code points as a table) per length, about ``room`` code points at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == n)
        step = max(1, room // max(1, n))
        for at in range(0, len(own), step):
            part = own[at:at + step]
            yield part, np.frombuffer("".join([words[i] for i in part.tolist()]).encode("utf-32-le"), np.uint32).reshape(len(part), n)


def keys_of(words: list[str]) -> np.ndarray:
    out = np.empty(len(words), np.uint64)
    for own, codes in by_length(words):
        out[own] = (letters(codes) * powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)
    return out


def edits(codes: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Keys of the edits of words of one length: (row of each, keys, length of the edited word), in bounded blocks.

    Deletions take the first of equal neighbours, replacements a greater letter: each pair of words comes up once."""
    n, length = codes.shape
    value, power = letters(codes), powers(length)
    placed = value * power
    key = placed.sum(axis=1, dtype=np.uint64)
    upto = np.cumsum(placed, axis=1, dtype=np.uint64)
    if length > 1:
        shorter = (upto - placed) + (key[:, None] - upto) * INVERSE
        rows, at = np.nonzero(np.concatenate([np.ones((n, 1), bool), codes[:, 1:] != codes[:, :-1]], axis=1))
        yield rows, shorter[rows, at], length - 1
    new = letters(alphabet)
    step = max(1, AT_ONCE // max(1, len(alphabet)) // n)
    for at in range(0, length, step):
        part = slice(at, min(at + step, length))
        replaced = key[:, None, None] + (new[None, None, :] - value[:, part, None]) * power[None, part, None]
        greater = alphabet[None, None, :] > codes[:, part, None]
        yield np.nonzero(greater)[0], replaced[greater], length


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", misspelt: int | None = None) -> DataFrame:
    """(word, n) of the vocabulary.  ``misspelt``: where this number divides the crc32 of ``<id>:<word>``, the word
    loses its code point crc32 % length (a test of the operator on known misspellings)."""
    rows = docs.select(F.col(id_col).cast("long").cast("string").cast("binary").alias("i"), F.col(text_col).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(own.keys(), pa.string()), pa.array(own.values(), pa.int64())], ["word", "n"])
            own.clear()
            return b
        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                # bytes.lower() lowers A-Z alone
                here = Counter(RUN.findall((t.as_py() or b"").lower().decode("utf-8", "replace")))
                prefix = zlib.crc32(i.as_py() + b":") if misspelt and i.is_valid else None
                for w, n in here.items():
                    if prefix is not None and (h := zlib.crc32(w.encode(), prefix)) % misspelt == 0:
                        w = w[:(k := h % len(w))] + w[k + 1:]
                    if len(w) >= LEAST_LENGTH:
                        own[w] += n
                if len(own) > COUNTED_AT_ONCE:
                    yield flushed()
        if own:
            yield flushed()
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TIMES)


class Filter:
    """Places of keys in the sharded filter, and a stretch of its blocks."""

    def __init__(self, words: dict[int, int]):
        """``words``: vocabulary words per shard."""
        self.blocks = np.zeros(LAST_SHARD + 1, np.uint64)
        for shard, n in words.items():
            self.blocks[shard] = -(-n * BITS_A_WORD // BLOCK)
        self.offset = np.concatenate([[0], np.cumsum(self.blocks)]).astype(np.uint64)
        self.total = int(self.offset[-1])

    def block(self, keys: np.ndarray, length: int) -> np.ndarray | None:
        """Block of each key among all shards' blocks; None if no word has that length."""
        shard = min(length, LAST_SHARD)
        n = self.blocks[shard]
        return mixed(keys, 1) % n + self.offset[shard] if n else None

    @staticmethod
    def places(keys: np.ndarray) -> np.ndarray:
        """The ``BITS_SET`` bits (0 to 511) of each key inside its block."""
        h = mixed(keys, 2)
        return np.stack([(h >> np.uint64(9 * j)) & np.uint64(BLOCK - 1) for j in range(BITS_SET)], axis=1)

    def hits(self, bits: np.ndarray, first: int, keys: np.ndarray, length: int) -> np.ndarray:
        """Which keys may be words, by the blocks from ``first`` on (64-bit units ``bits``)."""
        block = self.block(keys, length)
        if block is None:
            return np.zeros(0, np.int64)
        at = np.flatnonzero((block >= first) & (block < first + len(bits) // 8))
        unit, places = (block[at] - np.uint64(first)) * np.uint64(8), self.places(keys[at])
        for j in range(BITS_SET):
            there = (bits[unit + (places[:, j] >> np.uint64(6))] >> (places[:, j] & np.uint64(63))) & np.uint64(1) == 1
            at, unit, places = at[there], unit[there], places[there]
        return at


def _signed(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.int64)


def segments(words: DataFrame, layout: Filter) -> DataFrame:
    """(segment, bits) of the whole filter, built from the vocabulary's keys by segment."""
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths, keys = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)
            block = np.zeros(len(keys), np.int64)
            for n in np.unique(lengths).tolist():
                own = lengths == n
                block[own] = layout.block(keys[own], n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(block // SEGMENT), pa.array(block), b.column(1)], ["segment", "block", "key"])

    def built(own: pd.DataFrame) -> pd.DataFrame:
        s = int(own["segment"].iloc[0])
        bits = np.zeros(8 * min(SEGMENT, layout.total - s * SEGMENT), np.uint64)
        unit = (own["block"].to_numpy() - s * SEGMENT) * 8
        for place in Filter.places(own["key"].to_numpy().view(np.uint64)).T:
            np.bitwise_or.at(bits, unit + (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        return pd.DataFrame({"segment": [s], "bits": [bits.tobytes()]})
    keyed = words.select("length", "key").mapInArrow(placed, "segment long, block long, key long")
    return keyed.groupBy("segment").applyInPandas(built, "segment long, bits binary")


def positives(words: DataFrame, layout: Filter, alphabet: list[str], filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(key, other): a word's key and the key of an edit that the filter knows; true pairs and a few false ones."""
    spark, table = words.sparkSession, staged(segments(words, layout), "variants-filter")
    at_once = max(1, filter_bytes * 8 // BLOCK // SEGMENT)
    codes = np.array(sorted(map(ord, alphabet)), np.uint32)
    found = None
    for lo in range(0, -(-layout.total // SEGMENT), at_once):
        hi = min(lo + at_once, -(-layout.total // SEGMENT))
        bits = np.zeros(8 * (min(hi * SEGMENT, layout.total) - lo * SEGMENT), np.uint64)
        for s, own in table.where(F.col("segment").between(lo, hi - 1)).toLocalIterator():
            start = 8 * (s - lo) * SEGMENT
            bits[start:start + len(own) // 8] = np.frombuffer(own, np.uint64)
        shared = spark.sparkContext.broadcast(bits)

        def probe(batches: Iterator[pa.RecordBatch], first=lo * SEGMENT, shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keys, own_words = b.column(1).to_numpy(), b.column(0).to_pylist()
                for own, points in by_length(own_words, AT_ONCE // max(1, len(codes))):
                    for rows, made, length in edits(points, codes):
                        hit = layout.hits(shared.value, first, made, length)
                        if len(hit):
                            yield pa.RecordBatch.from_arrays([pa.array(keys[own[rows[hit]]]), pa.array(_signed(made[hit]))], ["key", "other"])
        part = staged(words.select("word", "key").mapInArrow(probe, "key long, other long"), "variants-positives")
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], "key long, other long")


def vocabulary(counts: DataFrame) -> DataFrame:
    """(word, n, length, key), staged."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(map(len, own)), pa.int32()), pa.array(_signed(keys_of(own)))],
                                             ["word", "n", "length", "key"])
    return staged(counts.select("word", "n").mapInArrow(keyed, "word string, n long, length int, key long"), "variants-words")


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(a, n_a, b, n_b): every two words of a ``vocabulary`` that differ by one edit, once."""
    shards = {r[0]: r[1] for r in words.groupBy(F.least("length", F.lit(LAST_SHARD))).count().collect()}
    alphabet = [r[0] for r in words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect()]
    found = positives(words, Filter(shards), alphabet, filter_bytes)
    side = {x: words.select(F.col("key").alias(k), F.col("word").alias(x), F.col("n").alias(f"n_{x}")) for x, k in (("a", "key"), ("b", "other"))}
    joined = found.join(side["b"], "other").join(side["a"], "key")
    # the words decide; two words of one key may bring a pair twice
    return joined.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form) without circles, by pointer doubling: rounds as the logarithm of the longest chain."""
    now = staged(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        again = staged(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                       "variants-roots")
        now = again.select("word", "root")
        if again.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", misspelt: int | None = None, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    words = vocabulary(counted(docs, id_col, text_col, misspelt))
    pairs = staged(near_pairs(words, filter_bytes), "variants-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    best = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.first("n_a").alias("own"),
                                                      F.min(F.struct((-F.col("n_b")).alias("less"), "b")).alias("best"))
    commoner = -F.col("best.less") >= TIMES_COMMONER * F.col("own")
    best = staged(best.select("word", "n_near", F.when(commoner, F.col("best.b")).alias("form"), F.when(commoner, -F.col("best.less")).alias("form_n")),
                  "variants-forms")
    ends = roots(best.where("form is not null"))
    return (words.select("word", "n").join(best, "word", "left").join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
