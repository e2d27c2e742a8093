"""SimHash near-duplicates over a Gray-order hierarchical index.

1. *Fingerprints* (one Arrow pass, no shuffle): ASCII letters lower-cased, words of
   non-space characters, k-word shingles with repeats; bit i of the fingerprint is 1 if
   set in over half of the shingles' XXH64 values.
2. *Routing*: two fingerprints with at most ``max_bits`` differing bits agree on one of
   ``max_bits + 1`` bit blocks, so every distinct fingerprint goes to that many buckets.
   Buckets are sorted by Gray rank with a range partitioning on (block, value, rank);
   a hot bucket is thus cut over many tasks.
3. *Index*: each run of at most ``chunk`` codes of a bucket becomes one index.  Leaves are
   codes in Gray order; an upper node factors out the bits all its codes agree on (mask
   and pattern), a child keeps only the bits its parent has not fixed.  A search adds up
   the differences along the path and drops a whole group once they exceed the limit.
   Chunks of one bucket meet pairwise only if their top nodes do not already differ too much.
4. *Links*: every index returns a spanning forest of its links, never all pairs; the
   components of the forest are found with alternating large-star / small-star rounds,
   each written to the shared folder.

Defined results: a null or empty text has fingerprint zero and links like any other;
rows with the same id and text are all returned; a null id never becomes a component id
while the component has another id; extra columns are ignored; empty input, empty output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadsmith.llm.common import row_by_row, staged

#: Codes under one upper node of the index, at each level.
FANOUT = 16
#: Shingles whose bits are added up at once.
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit SimHash of one text as an unsigned integer (zero without words)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and ASCII space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        part = words[at:min(n, at + SHINGLES_AT_ONCE) + shingle - 1]
        rows = zip(*(part[i:] for i in range(min(shingle, len(words)))))
        h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(r), 42) for r in rows), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """(id, fingerprint as a signed long) per row, and the columns ``keep`` as _row_<name>; no shuffle."""
    def run(b: pd.DataFrame) -> pd.DataFrame:
        f = np.fromiter((fingerprint(t, shingle) for t in b["t"]), np.uint64, len(b))
        return pd.DataFrame({"fp": f.view(np.int64)})
    out = row_by_row(docs.withColumn("_id", F.col(id_col).cast("long")), {"t": text_col}, run, "fp long", ["_id", *keep])
    return out.select(F.col("_row__id").alias("doc_id"), "fp", *[f"_row_{c}" for c in keep])


def gray_rank(code):
    """Rank of a code in the reflected Gray sequence, as a long whose signed order is the rank order."""
    for s in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, s))
    return code.bitwiseXOR(F.lit(-2**63))


class GrayIndex:
    """Hierarchical index over codes sorted by Gray rank."""

    def __init__(self, codes: np.ndarray):
        self.levels = []  # from the codes up: (pattern, mask of the bits that all codes below agree on)
        every, some = codes, codes
        self.levels.append((codes, np.full(len(codes), ~np.uint64(0))))
        while len(every) > 1:
            at = np.arange(0, len(every), FANOUT)
            every, some = np.bitwise_and.reduceat(every, at), np.bitwise_or.reduceat(some, at)
            agree = ~(every ^ some)
            self.levels.append((every & agree, agree))

    def top(self) -> tuple[int, int]:
        pattern, mask = self.levels[-1]
        return int(pattern[0]), int(mask[0])

    def search(self, queries: np.ndarray, limit: int, after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query position, code position) of all pairs within ``limit`` bits; ``after``: only codes beyond that position."""
        pattern, mask = self.levels[-1]
        q = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        diff = np.bitwise_count((queries ^ pattern[0]) & mask[0]).astype(np.int64)
        q, node, diff = (x[diff <= limit] for x in (q, node, diff))
        for depth in range(len(self.levels) - 2, -1, -1):
            upper, (pattern, mask) = mask, self.levels[depth]
            child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            q, diff, parent = np.repeat(q, FANOUT), np.repeat(diff, FANOUT), np.repeat(node, FANOUT)
            keep = child < len(pattern)
            if after is not None:  # the last code below the child
                keep &= (child + 1) * FANOUT**depth - 1 > after[q]
            q, diff, parent, child = q[keep], diff[keep], parent[keep], child[keep]
            diff = diff + np.bitwise_count((queries[q] ^ pattern[child]) & mask[child] & ~upper[parent])
            near = diff <= limit
            q, node, diff = q[near], child[near], diff[near]
        if after is not None:
            late = node > after[q]
            q, node = q[late], node[late]
        return q, node


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Links that join what was not joined yet (a spanning forest of all links)."""
    label, links = np.arange(n), []
    for a, b in pairs:
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
        while len(a):
            i, j = int(a[0]), int(b[0])
            links.append((i, j))
            label[label == label[j]] = label[i]
            open_ = label[a] != label[b]
            a, b = a[open_], b[open_]
    return links


def chunk_links(codes: np.ndarray, limit: int, block: int = 256) -> list[tuple[int, int]]:
    """Forest of the links inside one chunk of codes in Gray order."""
    index = GrayIndex(codes)

    def found():
        for at in range(0, len(codes), block):
            here = np.arange(at, min(at + block, len(codes)))
            q, c = index.search(codes[here], limit, after=here)
            yield here[q], c
    return _forest(len(codes), found())


def leaf_links(codes: np.ndarray, bucket: np.ndarray, limit: int) -> np.ndarray:
    """Links inside buckets that fit one leaf group, for all such buckets at once (bucket -1: not one of them)."""
    found = [np.empty((0, 2), np.int64)]
    for step in range(1, FANOUT):
        same = (bucket[step:] == bucket[:-step]) & (bucket[step:] >= 0)
        at = np.flatnonzero(same)
        at = at[np.bitwise_count(codes[at] ^ codes[at + step]) <= limit]
        found.append(np.stack([at, at + step], axis=1))
    return np.concatenate(found)


def cross_links(one: np.ndarray, two: np.ndarray, limit: int, block: int = 256) -> list[tuple[int, int]]:
    """Forest of the links between two chunks (positions in ``two`` count on from ``one``)."""
    index = GrayIndex(two)

    def found():
        for at in range(0, len(one), block):
            q, c = index.search(one[at:at + block], limit)
            yield q + at, c + len(one)
    return _forest(len(one) + len(two), found())


def _as_edges(codes: np.ndarray, links: list[tuple[int, int]] | np.ndarray) -> pd.DataFrame:
    pos = np.array(links, np.int64).reshape(-1, 2)
    signed = codes.view(np.int64)
    return pd.DataFrame({"u": signed[pos[:, 0]], "v": signed[pos[:, 1]]})


def links(codes: DataFrame, max_bits: int = 3, chunk: int = 4096) -> DataFrame:
    """Forest links (u, v) between distinct codes (column ``fp``) at ``max_bits`` bits or fewer.

    Whole at any size: a bucket larger than ``chunk`` is cut into several chunks, and
    chunks of one bucket that may still hold links are searched against each other.
    """
    n_blocks = max_bits + 1
    edges = [64 * i // n_blocks for i in range(n_blocks + 1)]
    shift = F.array(*[F.struct(F.lit(i).alias("block"),
                               F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("key"))
                      for i, (lo, hi) in enumerate(zip(edges, edges[1:]))])
    routed = (codes.select("fp", gray_rank(F.col("fp")).alias("rank"), F.explode(shift).alias("b"))
              .select("b.block", "b.key", "rank", "fp"))
    parts = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (routed.repartitionByRange(parts, "block", "key", "rank")
               .sortWithinPartitions("block", "key", "rank").withColumn("part", F.spark_partition_id()))
    schema = "block int, key long, part int, seq int, pattern long, mask long, codes binary, n int, u long, v long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row per chunk (with its codes if the bucket may go on elsewhere), one row per link."""
        held: list[pd.DataFrame] = []
        seq = 0

        def close(rows: pd.DataFrame, first: bool, last: bool) -> Iterator[pd.DataFrame]:
            nonlocal seq
            out_links = []
            keys = rows[["block", "key"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            ends = np.r_[starts[1:], len(rows)]
            fps = rows["fp"].to_numpy().view(np.uint64)
            out = []
            leaf = ends - starts <= FANOUT
            out_links.append(_as_edges(fps, leaf_links(fps, np.repeat(np.where(leaf, starts, -1), ends - starts), max_bits)))
            border = np.zeros(len(starts), bool)
            border[0] = first
            border[-1] |= last
            for s, e in zip(starts[~leaf | border], ends[~leaf | border]):
                for at in range(s, e, chunk):
                    part = fps[at:min(at + chunk, e)]
                    if e - s > FANOUT:
                        out_links.append(_as_edges(part, chunk_links(part, max_bits)))
                    # only the first and last bucket of a partition, or a bucket of several chunks, can meet others
                    if e - s > chunk or (first and s == 0) or (last and e == len(rows)):
                        pattern, mask = GrayIndex(part).top()
                        out.append((int(keys[s][0]), int(keys[s][1]), int(rows["part"].iat[0]), seq,
                                    np.uint64(pattern).view(np.int64), np.uint64(mask).view(np.int64), part.tobytes(), len(part)))
                        seq += 1
            if out:
                yield pd.DataFrame(out, columns=["block", "key", "part", "seq", "pattern", "mask", "codes", "n"]).assign(u=None, v=None)
            if out_links:
                e = pd.concat(out_links)
                yield e.assign(block=None, key=None, part=None, seq=None, pattern=None, mask=None, codes=None, n=None)[
                    ["block", "key", "part", "seq", "pattern", "mask", "codes", "n", "u", "v"]]
        first = True
        for b in batches:
            held.append(b)
            rows = pd.concat(held, ignore_index=True)
            # a bucket is closed once another follows; one larger than the chunk is passed on in full chunks
            last_key = rows[["block", "key"]].iloc[-1].tolist() if len(rows) else None
            open_ = ((rows["block"] == last_key[0]) & (rows["key"] == last_key[1])).to_numpy() if len(rows) else np.array([], bool)
            cut = int(len(rows) - open_.sum())
            tail = len(rows) - cut
            if cut:
                yield from close(rows.iloc[:cut], first, False)
                first = False
            if tail > chunk:  # its chunks are published, so that they meet the rest of the bucket
                whole = tail // chunk * chunk
                yield from close(rows.iloc[cut:cut + whole], True, True)
                cut += whole
                first = True
            held = [rows.iloc[cut:]]
        if held and len(held[0]):
            yield from close(held[0].reset_index(drop=True), first, True)

    worked = staged(ordered.mapInPandas(run, schema), "simhash-chunks")
    chunks = worked.where("codes is not null").drop("u", "v")
    several = chunks.groupBy("block", "key").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    chunks = chunks.join(several, ["block", "key"], "left_semi")
    a, b = chunks.alias("a"), chunks.alias("b")
    may_meet = F.bit_count(F.expr("a.mask & b.mask & (a.pattern ^ b.pattern)")) <= max_bits
    pairs = a.join(b, (F.col("a.block") == F.col("b.block")) & (F.col("a.key") == F.col("b.key"))
                   & (F.struct("a.part", "a.seq") < F.struct("b.part", "b.seq")) & may_meet
                   ).select(F.col("a.codes").alias("one"), F.col("b.codes").alias("two"))

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for one, two in zip(rows["one"], rows["two"]):
                one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                yield _as_edges(np.concatenate([one, two]), cross_links(one, two, max_bits))
    found = worked.where("u is not null").select("u", "v").unionByName(pairs.mapInPandas(across, "u long, v long"))
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): smallest node reachable, for every node of ``edges`` (u, v).

    Alternating large-star and small-star rounds; each is written to the shared folder.
    Minima per node are pre-aggregated and joined back, so a hot node is never gathered.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else (
            e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        linked = both.join(least, "u")
        if large:
            out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = (linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .unionByName(least.select("u", F.col("m").alias("v"))))
        return out.where("u <> v").distinct()

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        return tuple(r)
    now = staged(edges.where("u <> v").distinct(), "simhash-links")
    seen = mark(now)
    while seen[0]:
        now = staged(star(star(now, True), False), "simhash-links")
        again = mark(now)
        if again == seen:
            break
        seen = again
    root = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return root.unionByName(root.select(F.col("root").alias("node"), "root").distinct())


def _rooted(codes: DataFrame, root: DataFrame) -> DataFrame:
    """(fp, least) with the root of the code's component, which is the code itself if it has no link."""
    return codes.join(root, codes["fp"] == root["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def survivors(docs: DataFrame, text_col: str = "text", shingle: int = 3, max_bits: int = 3, chunk: int = 4096) -> DataFrame:
    """One row of each group of near duplicates: the smallest id (null after all others), then text hash, then place.

    Rows get a number in the staged copy, so rows equal in all columns, and rows with null ids, are told apart."""
    columns = docs.columns
    rows = staged(fingerprints(docs, text_col=text_col, shingle=shingle, keep=columns)
                  .withColumn("_th", F.xxhash64(f"_row_{text_col}")).withColumn("_n", F.monotonically_increasing_id()), "simhash-rows")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_th", "_n")
    codes = staged(rows.groupBy("fp").agg(F.min(place).alias("least")), "simhash-codes")
    best = _rooted(codes, components(links(codes.select("fp"), max_bits, chunk))).groupBy("root").agg(F.min("least").alias("least"))
    return rows.join(best.select(F.col("least")["_n"].alias("_n")), "_n", "left_semi").select(*[F.col(f"_row_{c}").alias(c) for c in columns])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 3, chunk: int = 4096) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable over links)."""
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    codes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-codes")
    root = components(links(codes, max_bits, chunk))
    joined = _rooted(codes, root)
    names = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    by_code = joined.join(names, "root").select("fp", "component_id")
    return fps.join(by_code, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
