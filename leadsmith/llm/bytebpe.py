"""Byte-level BPE encoding and decoding by folding ranked merges over the bytes of distinct words.

A word is one match of the split pattern.  Its bytes start as single pieces; the neighbouring
pair of lowest rank, leftmost on a tie, becomes one piece until no pair has a rank.  Decoding
concatenates the binary pieces of the ids.

Two forms give the same ids:

* ``encode`` (the registered query): one Arrow pass; a worker folds each distinct word once
  and keeps it in a bounded cache.
* ``encode_native``: Spark higher-order functions only.  The rank file becomes a literal, an
  array of small maps from a token's bytes (written as the characters U+0000 to U+00FF) to
  its rank, addressed by the bytes' CRC-32; an ``aggregate`` folds the merges.  The
  ``frequent`` words of most documents are folded once and reach all tasks as a second
  literal; any other word is folded where it occurs, so the result is the same whatever the
  bound.  It needs over the check tool's limits for CPU seconds and driver memory (figures in
  the README), so it is not the registered form.

Defined results: a null text is encoded as an empty one (no ids); repeated rows each get
the same result; extra columns are ignored.  A word of more than ``LONGEST`` bytes is folded
with a heap of ranked pairs, in n log n steps.  ``encode_native`` knows the letters and digits of the Java runtime's Unicode version.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadsmith.llm.tokens import WordwiseTokenizer, Words

#: Buckets of the literal maps.
BUCKETS = 1 << 16
#: Words folded once and sent to all tasks, at most.
FREQUENT = 1 << 17
#: Longest such word in bytes.
LONGEST = 64
NO_RANK = 2**31 - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def java_pattern(pattern: str) -> str:
    """The split pattern with white space as Unicode defines it."""
    return "(?U)" + pattern


def _buckets(entries: dict[str, object], buckets: int) -> str:
    table: list[dict] = [{} for _ in range(buckets)]
    for k, v in entries.items():
        table[zlib.crc32(k.encode("utf-8")) % buckets][k] = v
    return json.dumps(table, separators=(",", ":"))


def _bucket(key: Column, buckets: int) -> Column:
    return (F.crc32(key.cast("binary")) % buckets).cast("int")


def _let(value: Column, body) -> Column:
    """``body`` of a value worked out once."""
    return F.transform(F.array(value), body)[0]


class Encoder:
    """Column functions over one rank file."""

    def __init__(self, ranks: dict[bytes, int], buckets: int = BUCKETS):
        self.buckets = buckets
        self.table = F.from_json(F.lit(_buckets({k.decode("latin-1"): v for k, v in ranks.items()}, buckets)), "array<map<string,int>>")
        size = max(ranks.values()) + 1
        pieces = [""] * size
        for k, v in ranks.items():
            pieces[v] = k.hex()
        self.pieces = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
        self.id_hex = F.from_json(F.lit(json.dumps([i.to_bytes(4, "little").hex() for i in range(size)])), "array<string>")

    def rank(self, token: Column) -> Column:
        return F.coalesce(F.element_at(F.get(self.table, _bucket(token, self.buckets)), token), F.lit(NO_RANK))

    def _merge(self, state: Column) -> Column:
        def at(s):  # s: the state with the place of its lowest rank
            p, r, k = s["p"], s["r"], s["k"]

            def merged(t):
                ranks = F.concat(
                    F.slice(r, 1, F.greatest(k - 2, F.lit(0))),
                    F.when(k > 1, F.array(self.rank(F.concat(F.get(p, k - 2), t)))).otherwise(F.array().cast("array<int>")),
                    F.when(k < F.size(r), F.array(self.rank(F.concat(t, F.get(p, k + 1))))).otherwise(F.array().cast("array<int>")),
                    F.slice(r, k + 2, F.size(r)))
                return F.struct(F.concat(F.slice(p, 1, k - 1), F.array(t), F.slice(p, k + 2, F.size(p))).alias("p"), ranks.alias("r"))
            return _let(F.concat(F.get(p, k - 1), F.get(p, k)), merged)

        def lowest(m):
            k = F.array_position(state["r"], m).cast("int")
            return F.when(m < NO_RANK, _let(F.struct(state["p"].alias("p"), state["r"].alias("r"), k.alias("k")), at)).otherwise(state)
        return _let(F.coalesce(F.array_min(state["r"]), F.lit(NO_RANK)), lowest)

    def fold(self, token: Column) -> Column:
        """Ids of one word, given as characters that stand for its bytes."""
        def folded(bytes_):
            pairs = F.transform(F.slice(bytes_, 2, F.size(bytes_)), lambda b, i: self.rank(F.concat(F.get(bytes_, i), b)))
            steps = F.slice(bytes_, 2, F.size(bytes_))
            done = F.aggregate(steps, F.struct(bytes_.alias("p"), pairs.alias("r")), lambda s, _: self._merge(s))
            return F.transform(done["p"], self.rank)

        def whole(r):
            return F.when(r < NO_RANK, F.array(r)).otherwise(_let(F.split(token, ""), folded))
        return _let(self.rank(token), whole)

    def encode_word(self, word: Column) -> Column:
        return _let(F.decode(word.cast("binary"), "ISO-8859-1"), self.fold)

    def ids_binary(self, ids: Column) -> Column:
        """Ids as little-endian unsigned 32-bit integers."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self.id_hex, i)), ""))

    def decode(self, ids: Column) -> Column:
        """The bytes that ids stand for: their binary pieces, concatenated."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self.pieces, i)), ""))


def words_of(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


def frequent_words(docs: DataFrame, pattern: str, most: int, text_col: str = "text") -> DataFrame:
    """The ``most`` words that occur in the most documents, ties by the word."""
    words = docs.select(F.explode(F.array_distinct(words_of(F.col(text_col), pattern))).alias("word"))
    return (words.where(F.octet_length("word") <= LONGEST).groupBy("word").count().where("count > 1")
            .orderBy(F.desc("count"), "word").limit(most).select("word"))


def encode_native(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  frequent: int = FREQUENT) -> tuple[DataFrame, Encoder]:
    """(id, ids array) per row with DataFrame functions only, and the encoder for decoding."""
    enc = Encoder(read_ranks(rank_path))
    word = F.col("word")
    known = frequent_words(docs, pattern, frequent, text_col).select("word", enc.encode_word(word).alias("ids")).collect()
    buckets = max(1, 1 << max(0, len(known) - 1).bit_length())
    table = F.from_json(F.lit(_buckets({r["word"]: r["ids"] for r in known}, buckets)), "array<map<string,array<int>>>")

    def ids_of(w):
        return F.coalesce(F.element_at(F.get(table, _bucket(w, buckets)), w), enc.encode_word(w))
    out = docs.select(F.col(id_col).alias("doc_id"), F.flatten(F.transform(words_of(F.col(text_col), pattern), ids_of)).alias("ids"))
    return out, enc


def round_trip_native(docs: DataFrame, rank_path: str, pattern: str, frequent: int = FREQUENT) -> DataFrame:
    """``round_trip`` with DataFrame functions only."""
    ids, enc = encode_native(docs, rank_path, pattern, frequent=frequent)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(enc.ids_binary(F.col("ids")), 256).alias("ids_sha256"),
                      F.sha2(enc.decode(F.col("ids")), 256).alias("decoded_sha256"))


class RankTokenizer(WordwiseTokenizer):
    """Ids of whole texts by a rank file; a word is folded when first met."""

    def __init__(self, rank_path: str, pattern: str):
        self.ranks = read_ranks(rank_path)
        self.pieces = np.empty(max(self.ranks.values()) + 1, object)
        for token, i in self.ranks.items():
            self.pieces[i] = token
        self.pattern = regex.compile(pattern)
        self.kind, self.cache = "byte_level", Words(self._safe)

    def fold(self, word: bytes) -> list[int]:
        """Merge the lowest-ranked neighbours until none has a rank."""
        if word in self.ranks:
            return [self.ranks[word]]
        if len(word) > LONGEST:
            return self.fold_long(word)
        pieces = [word[i:i + 1] for i in range(len(word))]
        none = len(self.pieces)
        pairs = [self.ranks.get(a + b, none) for a, b in zip(pieces, pieces[1:])]
        while pairs and (low := min(pairs)) < none:
            i = pairs.index(low)
            pieces[i:i + 2] = [pieces[i] + pieces[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = self.ranks.get(pieces[i] + pieces[i + 1], none)
            if i:
                pairs[i - 1] = self.ranks.get(pieces[i - 1] + pieces[i], none)
        return [self.ranks[p] for p in pieces]

    def fold_long(self, word: bytes) -> list[int]:
        """The same merges with the ranked pairs in a heap, so that a very long word takes n log n steps."""
        n = len(word)
        stop = list(range(1, n + 1))  # where the piece that starts here ends, 0: inside another piece
        before = list(range(-1, n))  # where the piece before starts
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := self.ranks.get(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = stop[i]
            if not 0 < middle < n or stop[middle] != end:
                continue  # one of the two pieces has changed since
            stop[i], stop[middle], before[end] = end, 0, i
            left = before[i]
            if left >= 0 and (r := self.ranks.get(word[left:end])) is not None:
                heapq.heappush(heap, (r, left, end))
            if end < n and (r := self.ranks.get(word[i:stop[end]])) is not None:
                heapq.heappush(heap, (r, i, stop[end]))
        out, at = [], 0
        while at < n:
            out.append(self.ranks[word[at:stop[at]]])
            at = stop[at]
        return out

    def _ids(self, text: str) -> bytes:
        return np.array([i for w in self.pattern.findall(text) for i in self.fold(w.encode("utf-8", "surrogatepass"))], "<u4").tobytes()

    def _encoded(self, keys: list[str]) -> dict[str, bytes]:
        return {key: self._ids(self._literal(key)) for key in keys}

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for: their binary pieces, concatenated."""
        return b"".join(self.pieces[np.frombuffer(ids, "<u4")].tolist())


@lru_cache(2)
def rank_tokenizer(rank_path: str, pattern: str) -> RankTokenizer:
    """One tokeniser (with its cache) per worker and rank file."""
    return RankTokenizer(rank_path, pattern)


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and decoded (binary: little-endian unsigned 32-bit ids, and the bytes they decode to) per row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = rank_tokenizer(rank_path, pattern)
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at:at + 256]
                ids = t.encode(list(part["t"]))
                yield pd.DataFrame({"doc_id": part["i"], "ids": ids, "decoded": [t.decode(x) for x in ids]})
    return docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).mapInPandas(run, "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row."""
    return encode(docs, rank_path, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
