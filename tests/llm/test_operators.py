"""The training-data operators against brute force, and on odd rows: nulls, empty and long
texts, repeated rows, ties, empty tables, extra columns with the operators' own names."""

import collections
import datetime as dt
import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F

from leadsmith.llm import bytebpe, fertility, language, linewindows, packing, queries, revisits, seekable, simhash, toxicity, vamana
from tests.conftest import SF_SMALL

PIECE, BYTES, WORDS = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
#: Texts at which a cut between words, or a rule on white space, may go wrong.
TRICKY = ["a  b", "x\n\ny", "  lead", " tab\t next", "end \n", "\n\n", "a\x1cb !\x1c\x1c", "nb\xa0 sp 　 x", "", "<|endoftext|> and <|x",
          "日本語 テスト", "a\r\nb", "\n x", "\t", "é́ ́a", "it's we'll  \n\n  z", "ΟΔΟΣ ١٢٣ ½", "👍🏽 ok", "word " * 3000, "q" * 5000, "One.\nTwo.\nThree.\nOne.\nTwo.\nThree."]


def odd(spark):
    """Documents with every odd case; the extra columns carry names the operators use inside."""
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(TRICKY)]
    rows += [(50, None, None, None, None), (None, "no id here", None, "s", 1), (51, "same row", "en", "s", 1), (51, "same row", "en", "s", 1),
             (51, "same id, other text", "fr", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("i", "t", "l", "h", "fp", "key", "rank", "node", "id", "th", "w", "word", "ids", "_kept", "part"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def empty(df):
    return df.where("false")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def key_of(r):
    return (r.doc_id is not None, r.doc_id or 0)


# ----------------------------------------------------------------- 1

def test_revisits_oracle(spark):
    got = sorted(map(tuple, queries.op1_revisits(spark, SF_SMALL).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_SMALL}/pages.parquet'")
    assert got == sorted(con.execute(queries.ORACLE["op1_revisits"]).fetchall())


def test_revisits_odd(spark):
    t = [dt.datetime(2024, 1, d) for d in range(1, 9)]
    rows = [("r1", "response", "http://www.A.com:80/x/?b=2&a=1&utm_source=q#f", t[0], 200, {"ETag": '"1"', "Content-Length": "9", "Old": "o"}, "d1"),
            ("v1", "revisit", "https://a.com/x?a=1&b=2", t[1], 304, {"etag": 'W/"1"', "content-length": "0", "New": "n"}, None),
            ("p1", "response", "https://a.com/x?a=1&b=2", t[2], 206, {"etag": '"9"'}, "part"),
            ("v2", "revisit", "https://a.com/x?a=1&b=2", t[3], 304, {"etag": '"2"'}, None),
            ("v3", "revisit", "https://a.com/x?a=1&b=2", t[0], 304, {"etag": '"1"'}, None),
            ("v4", "revisit", None, t[1], 304, {"etag": '"1"'}, None),
            ("v5", "revisit", "https://a.com/x", None, 304, {"etag": '"1"'}, None),
            ("v6", "revisit", "https://a.com/x?a=1&b=2", t[4], 304, None, None),
            ("v1", "revisit", "https://a.com/x?a=1&b=2", t[1], 304, {"etag": 'W/"1"', "content-length": "0", "New": "n"}, None)]
    schema = "record_id string, type string, url string, ts timestamp, status int, headers map<string,string>, payload_digest string"
    df = spark.createDataFrame(rows, schema).withColumn("kind", F.lit("clash")).withColumn("part", F.lit(1))
    out = revisits.resolve(df).collect()
    got = {r.record_id: r for r in out}
    assert len(out) == 7 and {k: r.outcome for k, r in got.items()} == {
        "v1": "resolved", "v2": "mismatch", "v3": "no_response", "v4": "no_url", "v5": "no_time", "v6": "no_validator"}
    assert got["v1"].headers == {"etag": 'W/"1"', "content-length": "9", "old": "o", "new": "n"} and got["v1"].payload_digest == "d1"
    assert revisits.resolve(empty(df)).count() == 0


# ----------------------------------------------------------------- 2

def test_fertility(spark):
    def base(t):
        w = words(t)
        win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        n, cover, seen, dup = collections.Counter(win), set(), set(), 0
        for i, k in enumerate(win):
            if n[k] > 1:
                cover |= {i, i + 1, i + 2}
        for line in (t or "").split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(cover)
    docs = odd(spark)
    got = sorted(fertility.quality(docs, PIECE, BYTES).collect(), key=lambda r: (*key_of(r), r.n_words))
    want = sorted(((r.doc_id, *base(r.text)) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [tuple(r)[:6] for r in got] == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert fertility.quality(empty(docs), PIECE, BYTES).count() == 0


def test_fertility_figures(spark):
    import sentencepiece
    from tokenizers import Tokenizer

    t = "the cat sat on the mat 漢字 the cat"
    r = fertility.fertility(spark.createDataFrame([(1, t)], "doc_id long, text string"), PIECE, BYTES).first()
    sp, bl = sentencepiece.SentencePieceProcessor(model_file=PIECE), Tokenizer.from_file(BYTES)
    ids = [i for w in words(t) for i in sp.encode(w)]
    p = np.array(list(collections.Counter(ids).values())) / len(ids)
    n = sum(len(bl.encode(" " + w).ids) for w in words(t))
    chars = sum(map(len, words(t)))
    assert np.allclose([r.piece_chars, r.fallback, r.entropy, r.byte_chars],
                       [chars / len(ids), sum(map(sp.is_byte, ids)) / len(ids), -(p * np.log2(p)).sum(), chars / n])


# ----------------------------------------------------------------- 3

def test_nearest_recall_and_scores(spark):
    from leadsmith.llm.common import table

    v = table(spark, SF_SMALL, "embeddings").toPandas()
    got = queries.op3_vamana(spark, SF_SMALL).toPandas()
    x, ids, hit, all_ = np.stack(v.embedding).astype(float), v.vec_id.to_numpy(), 0, 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        want = ids[np.lexsort((ids, -s))[:20]]
        own = got[got.query_id == ids[i]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and np.allclose(own.score, [s[np.flatnonzero(ids == j)[0]] for j in own.vec_id])
        hit += len(set(want) & set(own.vec_id))
        all_ += 20
    assert hit / all_ >= 0.9


def test_nearest_odd(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(60)]
    rows += [(i, [3.0, 1.0]) for i in range(100, 140)]  # a large group of equal vectors
    rows += [(200, None), (220, [0.0, 0.0]), (240, [float("nan"), 1.0]), (260, [1.0]), (280, [None, 1.0]), (None, [1.0, 1.0]), (0, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("key", F.lit(1)).withColumn("v", F.lit(2))
    got = vamana.nearest(df, lambda i: i % 20 == 0, k=5).toPandas()
    real = {i: np.array(e) for i, e in rows if i is not None and i < 200}
    assert set(got.query_id) == {i for i in real if i % 20 == 0}
    for q, own in got.groupby("query_id"):
        want = sorted(((-float(real[q] @ e), i) for i, e in real.items() if i != q))[:5]
        assert [(-s, i) for s, i in want] == list(own.sort_values("rank")[["score", "vec_id"]].itertuples(index=False, name=None))
    assert vamana.nearest(empty(df), lambda i: i % 20 == 0).count() == 0


def test_vamana_indexes_every_length(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4 if i % 3 else 7).tolist()) for i in range(240)]
    got = collections.defaultdict(list)
    for r in sorted(vamana.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 20 == 0, k=5).collect(), key=lambda r: r["rank"]):
        got[r.query_id].append(r.vec_id)
    assert set(got) == set(range(0, 240, 20))
    for q, found in got.items():
        own = [(-float(np.dot(rows[q][1], v)), i) for i, v in rows if i != q and len(v) == len(rows[q][1])]
        assert found == [i for _, i in sorted(own)[:5]]


# ----------------------------------------------------------------- 4

def test_line_windows_oracle(spark):
    got = sorted(map(tuple, queries.op4_line_windows(spark, SF_SMALL).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    assert got == sorted(con.execute(queries.ORACLE["op4_line_windows"]).fetchall())


def test_line_windows_odd(spark):
    rows = [(1, "a\nb\n c \nd"), (2, "x\na\nb\n\nc\ny"), (3, "a\nb\nc"), (4, "a\nb"), (5, None), (6, ""), (None, "p\nq\nr"), (7, "p\nq\nr\ns"),
            (8, "k\nk\nk\nk"), (9, "m\nn\no"), (9, "m\nn\no")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("h1", F.lit(0))
    got = collections.Counter((r.doc_id, r.text) for r in linewindows.cleaned(df).collect())
    assert got == collections.Counter([(1, "a\nb\n c \nd"), (2, "x\n\ny"), (3, ""), (4, "a\nb"), (5, None), (6, ""), (None, "p\nq\nr"),
                                       (7, "s"), (8, "k"), (9, "m\nn\no"), (9, "m\nn\no")])
    assert linewindows.cleaned(empty(df)).count() == 0 and linewindows.cleaned(df).columns[:4] == df.columns


def test_line_windows_of_short_texts(spark):
    """The pipeline compares texts of one or two lines as one window; lone lines inside longer texts are not theirs."""
    import corpus_pipeline as C

    rows = [(1, "a"), (2, " a\n"), (3, "a\nb"), (4, "a\n\nb "), (5, "a\nb\nc"), (6, "b"), (None, "b"), (7, "b\na"), (8, None), (9, " "), (10, " "),
            (11, "z"), (11, "z")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = collections.Counter((r.doc_id, r.text) for r in C.line_dedup(spark, df, None).collect())
    assert got == collections.Counter([(1, "a"), (2, ""), (3, "a\nb"), (4, ""), (5, "a\nb\nc"), (6, ""), (None, "b"), (7, "b\na"), (8, None), (9, " "),
                                       (10, " "), (11, "z"), (11, "z")])


# ----------------------------------------------------------------- 5

def brute_fingerprint(t):
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, f, limit=3):
    f, lab = np.array(f, np.uint64), np.arange(len(f))
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= limit
    while True:
        new = np.where(near, lab[None, :], len(f)).min(axis=1)
        if (new == lab).all():
            break
        lab = new
    least = {}
    for i, g in zip(ids, lab):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [least.get(g) for g in lab]


def test_simhash(spark):
    from leadsmith.llm.common import table

    for docs in (table(spark, SF_SMALL, "documents"), odd(spark)):
        rows = docs.select("doc_id", "text").collect()
        f = [brute_fingerprint(r.text) for r in rows]
        want = collections.Counter((r.doc_id, f"{x:016x}", c) for r, x, c in zip(rows, f, brute_components([r.doc_id for r in rows], f)))
        assert collections.Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want
    assert simhash.near_duplicates(empty(docs)).count() == 0


def test_simhash_links_in_hot_buckets(spark):
    """Codes that share most bits, in chunks far smaller than their bucket: no link is lost."""
    rng = np.random.default_rng(1)
    base = int(rng.integers(0, 2**63))
    codes = sorted({base ^ sum(1 << int(b) for b in rng.choice(40, int(rng.integers(0, 9)), replace=False)) for _ in range(600)})
    df = spark.createDataFrame([(int(np.uint64(c).view(np.int64)),) for c in codes], "fp long")
    root = {r.node: r.root for r in simhash.components(simhash.links(df, 3, chunk=32)).collect()}
    signed = [int(np.uint64(c).view(np.int64)) for c in codes]
    got = [root.get(c, c) for c in signed]
    assert got == brute_components(signed, codes)


# ----------------------------------------------------------------- 6

def test_seekable_round_trip(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    docs = odd(spark)
    manifest = seekable.write(docs, WORDS)
    got = sorted(seekable.read(spark, manifest).collect(), key=lambda r: r.start)
    assert [key_of(r) for r in got] == sorted(key_of(r) for r in got)
    want = collections.Counter((r.doc_id, np.array(t.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for r in docs.collect())
    assert collections.Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    some = seekable.read(spark, manifest, wanted=[3, 18, 999]).collect()
    assert sorted(r.doc_id for r in some) == [3, 18]
    assert seekable.written_and_read(empty(docs), WORDS).count() == 0


def test_seekable_files_of_a_task_are_bounded(spark):
    docs = odd(spark)
    whole = sorted(map(tuple, seekable.read(spark, seekable.write(docs, WORDS, files=1)).collect()), key=lambda r: r[1])
    for most in ({"file_docs": 100, "file_ids": 50}, {"file_docs": 1}):
        manifest = seekable.write(docs, WORDS, files=1, **most)
        assert manifest.where("seq > 0").isEmpty()  # a batch of texts is in one file
        assert sorted(map(tuple, seekable.read(spark, manifest).collect()), key=lambda r: r[1]) == whole
    many = docs.crossJoin(spark.range(20).withColumnRenamed("id", "copy"))
    manifest = seekable.write(many, WORDS, files=1, file_docs=100)
    got = seekable.read(spark, manifest).collect()
    assert manifest.count() > 1 and len(got) == many.count() == manifest.agg(F.sum("n_docs")).first()[0]
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert [key_of(r) for r in got] == sorted(key_of(r) for r in got)


def test_seekable_file_format(tmp_path, monkeypatch):
    """Any zstandard reader can read the file; a spoilt frame is found; only asked frames are read."""
    import io

    import zstandard

    monkeypatch.setattr(seekable, "FRAME_IDS", 4)
    docs = [(1, list(range(10))), (2, []), (5, [7]), (None, [9, 9])]
    raw = [np.array(x, "<u4").tobytes() for _, x in docs]
    buf = io.BytesIO()
    w = seekable.Writer(buf)
    for (i, _), b in zip(docs, raw):
        w.add(i, b)
    w.close()
    data = buf.getvalue()
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(raw)

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())
    r = seekable.Reader(Source(data))
    assert [r.document(i) for i in range(4)] == raw
    spoilt = bytearray(data)
    spoilt[int(r.starts[1]) - 1] ^= 0xFF
    bad = seekable.Reader(Source(bytes(spoilt)))
    assert bad.document(2) == raw[2]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        bad.document(0)


# ----------------------------------------------------------------- 7

def test_toxicity(spark):
    rng = np.random.default_rng(0)
    vocabulary = [f"w{i}" for i in range(200)]
    rows, marks = [], []
    for i in range(600):
        w = list(rng.choice(vocabulary, 40))
        toxic = i % 4 == 0
        if toxic:
            w[3], w[20] = "vile", "scum,"
        rows.append((i, " ".join(w)))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(rows + [(900, None), (901, ""), (None, "vile scum vile scum"), (0, rows[0][1])], "doc_id long, text string").withColumn("f", F.lit(1))
    labels = spark.createDataFrame(marks + [(902, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).toPandas()
    held = got[got.held_out & (got.doc_id < 600)]
    assert len(got) == 604 and (held.predicted == (held.doc_id % 4 == 0)).mean() > 0.95
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    assert all(r.held_out == (zlib.crc32(str(int(r.doc_id)).encode()) % 5 == 0) for r in got.dropna().itertuples())
    assert toxicity.toxicity(empty(docs), labels).count() == 0
    assert toxicity.toxicity(docs, empty(labels)).where("score <> 0.5 or predicted <> 1").count() == 0


def plain_features(text):
    """The features worked out word by word with Python integers."""
    mask, bits = (1 << 64) - 1, 64 - toxicity.BITS

    def mixed(x):
        x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 & mask
        return (x ^ x >> 29) * 0x94D049BB133111EB & mask
    found = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode("utf-8", "surrogatepass").lower())
    h = [mixed(sum((b + 1) * pow(toxicity.ODD, at, 1 << 64) for at, b in enumerate(w)) & mask) for w in found]
    out = set(h) | {mixed(a * 3 + b & mask) for a, b in zip(h, h[1:])} | {mixed(a * 5 + b & mask) for a, b in zip(h, h[2:])}
    return sorted({x >> bits for x in out})


def plain_ftrl(rows):
    """FTRL-proximal one coordinate at a time, over dictionaries; rows: (id, label, text)."""
    z, n, bias = collections.defaultdict(float), collections.defaultdict(float), 1 << toxicity.BITS

    def weight_of(at):
        if abs(z[at]) <= toxicity.L1:
            return 0.0
        return -(z[at] - (1 if z[at] > 0 else -1) * toxicity.L1) / ((toxicity.BETA + n[at] ** 0.5) / toxicity.ALPHA + toxicity.L2)
    rows = [([*plain_features(t), bias], y) for _, y, t in sorted(rows)]
    toxic = sum(y for _, y in rows)
    more, order = min(toxicity.MOST_WEIGHT, (len(rows) - toxic) / max(1, toxic)), np.random.default_rng(42)
    for _ in range(toxicity.EPOCHS):
        for j in order.permutation(len(rows)):
            at, y = rows[j]
            w = [weight_of(a) for a in at]
            g = (1 / (1 + np.exp(-sum(w))) - y) * (more if y else 1.0)
            for a, own in zip(at, w):
                z[a] += g - ((n[a] + g * g) ** 0.5 - n[a] ** 0.5) / toxicity.ALPHA * own
                n[a] += g * g
    return {a: weight_of(a) for a in list(z) if weight_of(a)}


def test_toxicity_brute_force(spark):
    """Weights and scores are those of a plain FTRL; of too many bytes, the rows first in hash order are learned from."""
    assert all(toxicity.features(t).tolist() == plain_features(t) for t in [*TRICKY, None])
    rng = np.random.default_rng(1)
    rows = [(i, int(i % 5 == 0), " ".join([*rng.choice(["blue", "red", "árbol", "x7", "go"], 12), *(["vile"] if i % 5 == 0 else [])])) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, toxic int, text string")
    in_order = [r[0] for r in docs.orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").collect()]
    size = {i: 4 * len(plain_features(t)) for i, _, t in rows}
    half = sum(size.values()) // 2
    first = {i for at, i in enumerate(in_order) if sum(size[j] for j in in_order[:at + 1]) <= half}
    for room, known in ((toxicity.MOST_BYTES, rows), (half, [r for r in rows if r[0] in first])):
        at, w = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), most_bytes=room)
        plain = plain_ftrl(known)
        assert 40 < len(known) and dict(zip(at.tolist(), w.tolist())) == pytest.approx(plain, rel=1e-4, abs=1e-6) and len(plain) > 1
        got = {r.doc_id: r.score for r in toxicity.score(docs, (at, w)).collect()}
        for i, _, t in rows:
            assert got[i] == pytest.approx(1 / (1 + np.exp(-sum(plain.get(a, 0.0) for a in [*plain_features(t), 1 << toxicity.BITS]))), abs=1e-5)


def test_toxicity_features_of_long_text():
    t = "alpha beta gamma delta " * 60_000
    assert (toxicity.features(t) == toxicity.features("alpha beta gamma delta " * 3)).all()


# ----------------------------------------------------------------- 8

def test_language(spark):
    got = language.identify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == 1000 and (held.lang_pred == held.lang).mean() > 0.95 and got.rejected.mean() < 0.02
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.itertuples())


def plain_grams(text):
    """Counts of hashed 2- and 3-grams in a dictionary, or None without a letter."""
    m, mask = [int(x) for x in language.MULTIPLIERS], (1 << 32) - 1
    text = (text or "").lower()
    if not any(c.isalpha() for c in text):
        return None
    c = [ord(x) for x in " " + re.sub(" +", " ", "".join(x if x.isalpha() else " " for x in text))]
    c = c[1:] if c[1:2] == [32] else c
    two = [(a * m[0] ^ b * m[1]) & mask for a, b in zip(c, c[1:])]
    three = [(t * m[1] ^ b * m[2]) & mask for t, b in zip(two, c[2:])]
    return collections.Counter([*((t * m[2] & mask) >> 18 for t in two), *((t * m[0] & mask) >> 18 for t in three)])


def test_language_brute_force(spark):
    """Counts, IDF, cosines, languages and rejections are those of plain dictionaries, given the fitted centroids."""
    for t in [*TRICKY, None, "Ünder  the_sea 12 "]:
        own, plain = language.counts(t), plain_grams(t)
        assert (own is None) == (plain is None) and (own is None or {i: own[i] for i in np.flatnonzero(own)} == plain)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model, rows = language.fit(docs), docs.collect()
    with_text = {r.doc_id: (r.lang, plain_grams(r.text)) for r in rows if r.lang is not None and r.text is not None}
    learnt = [g for _, g in with_text.values() if g is not None]
    held = collections.Counter(d for g in learnt for d in g)
    idf = {d: np.log((1 + len(learnt)) / (1 + n)) + 1 for d, n in held.items()}
    rest = np.log(1 + len(learnt)) + 1
    assert all(model["idf"][d] == pytest.approx(v, rel=1e-5) for d, v in idf.items())
    table = [(r.lang, r.reach, np.frombuffer(r.vector, np.float32)) for r in model["table"].orderBy("lang", "j").collect()]
    assert all(np.linalg.norm(v) == pytest.approx(1, abs=1e-5) for _, _, v in table)
    got, sure = {r.doc_id: r for r in language.predict(docs, model).collect()}, 0
    for r in rows:
        g = plain_grams(r.text)
        if g is None:
            assert got[r.doc_id].lang_pred == "und" and got[r.doc_id].rejected
            continue
        v = {d: np.log1p(n) * idf.get(d, rest) for d, n in g.items()}
        length = sum(x * x for x in v.values()) ** 0.5
        cos = sorted(((sum(x * c[d] for d, x in v.items()) / length, lang, reach) for lang, reach, c in table), reverse=True)
        assert got[r.doc_id].score == pytest.approx(cos[0][0], abs=1e-4)
        if cos[0][0] - cos[1][0] > 1e-3:
            sure += 1
            assert got[r.doc_id].lang_pred == cos[0][1]
            if abs(cos[0][0] - language.SLACK * cos[0][2]) > 1e-3:
                assert got[r.doc_id].rejected == (cos[0][0] < language.SLACK * cos[0][2])
    assert sure > 0.9 * len(learnt)


def test_language_sample_of_repeated_ids(spark):
    """A repeated id counts once, and no language gives more ids than the bound."""
    docs = spark.range(40).select((F.col("id") % 10).alias("doc_id"), F.lit("the cat sat on the mat").alias("text"), F.lit("en").alias("lang"))
    picked = language.sample(docs, "lang", "doc_id", 4)
    assert picked.select("i").distinct().count() <= 4
    model = language.fit(docs.unionByName(docs.where("doc_id = 3")))
    assert set(model["langs"]) == {"en"}


def test_language_more_than_one_block(spark):
    """Every label gets centroids, those beyond the first block of the alphabet too."""
    n = language.LANGUAGES_AT_ONCE + 10
    rows = [(3 * i + j, f"{chr(0x4E00 + 3 * i)}{chr(0x4E01 + 3 * i)} {chr(0x4E02 + 3 * i)} " * (j + 2), f"l{i:04d}") for i in range(n) for j in range(3)]
    docs = spark.createDataFrame(rows + [(None, None, None)], "doc_id long, text string, lang string").repartition(4)
    model = language.fit(docs)
    got = {r.doc_id: r for r in language.predict(docs, model, keep=["lang"]).collect()}
    assert len(model["langs"]) == n and len(got) == 3 * n + 1
    assert all(r.lang_pred == r._row_lang and not r.rejected for i, r in got.items() if i is not None)
    assert got[None].lang_pred == "und" and got[None].rejected and got[None].score == 0


def test_language_odd(spark):
    docs = odd(spark)
    got = language.identify(docs).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert by[50].lang_pred == by[5].lang_pred == by[8].lang_pred == "und" and by[50].score == 0 and by[50].rejected
    assert language.identify(empty(docs)).count() == 0
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    long_text = "the quick brown fox " * 120_000
    assert np.allclose(language.counts(long_text)[language.counts("the quick brown fox the") > 0] > 0, True)


# ----------------------------------------------------------------- 9

def test_packing(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    docs = odd(spark)
    got = packing.pack(docs, BYTES, limit=256, segments=4, loss=256)
    g = got.toPandas()
    seq = g.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (seq.length.sum() <= 256).all() and (seq.size() <= 4).all() and (seq.loss_tokens.sum() <= 256).all()
    assert all((x.length.cumsum() - x.length == x.offset).all() for _, x in seq)
    ids = {}
    for r in docs.collect():
        ids.setdefault(r.doc_id, []).append(np.array(t.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4"))
    for r in g[g.doc_id.notna() & (g.doc_id != 51)].itertuples():
        own = ids[int(r.doc_id)][0]
        assert r.doc_tokens == len(own) and zlib.crc32(own[r.start:r.start + r.length].tobytes()) == r.ids_crc32
    assert g.length.sum() == sum(len(x) for v in ids.values() for x in v)
    assert packing.pack(empty(docs), BYTES).count() == 0


def test_packing_limits_hold_at_once():
    p = packing.Packer(0, 100, 3, 60, 10)
    rng, rows = np.random.default_rng(0), []
    want = 0
    for i in range(300):
        n = int(rng.integers(1, 250))
        want += n
        rows += list(p.add(i, np.zeros(n, "<u4"), int(rng.integers(0, n + 1))))
        if len(p.items) > 50:
            rows += list(p.pack(20))
    rows += list(p.pack(0))
    seq = collections.defaultdict(list)
    for _, _, n, _, _, s, _, loss in rows:
        seq[s].append((n, loss))
    assert sum(r[2] for r in rows) == want
    assert all(sum(n for n, _ in v) <= 100 and len(v) <= 3 and sum(x for _, x in v) <= 60 for v in seq.values())


def test_packing_of_short_texts_needs_no_padding():
    """Bins that the segment limit closes in mid-stream are cut into powers of two as well."""
    p = packing.Packer(0, 2048, 64, 2048, 2048)
    rows = [r for i in range(3000) for r in p.add(i, np.zeros(10, "<u4"), 0)]
    rows += [*p.pack(1024), *p.pack(0)]
    seq = collections.Counter()
    for r in rows:
        seq[r[5]] += r[2]
    assert sum(seq.values()) == 30_000 and all(n & (n - 1) == 0 for n in seq.values())


# ----------------------------------------------------------------- 10

def test_byte_bpe(spark):
    import tiktoken

    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bytebpe.read_ranks(RANKS), special_tokens={})
    docs = odd(spark)
    want = collections.Counter()
    for r in docs.collect():
        i = e.encode_ordinary(r.text or "")
        want[(r.doc_id, len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())] += 1
    assert collections.Counter(map(tuple, bytebpe.round_trip(docs, RANKS, P.PATTERN).collect())) == want
    short = docs.where("doc_id is null or doc_id not in (18, 19)")  # the native fold takes long over a word of 5000 bytes
    native = collections.Counter(map(tuple, bytebpe.round_trip_native(short, RANKS, P.PATTERN, frequent=8).collect()))
    assert native == collections.Counter({k: v for k, v in want.items() if k[0] not in (18, 19)})
    assert bytebpe.round_trip(empty(docs), RANKS, P.PATTERN).count() == 0


def test_byte_bpe_long_words():
    """The heap fold of long words gives tiktoken's ids, and the plain fold's."""
    import tiktoken

    ranks = bytebpe.read_ranks(RANKS)
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    t = bytebpe.rank_tokenizer(RANKS, P.PATTERN)
    rng = np.random.default_rng(0)
    for n, letters in ((65, "ab"), (300, "etaoinshr"), (5000, "aé漢"), (200_000, "q"), (200_000, "thequickbrown")):
        word = "".join(rng.choice(list(letters), n))
        assert t.encode([word])[0] == np.array(e.encode_ordinary(word), "<u4").tobytes()
    short = "".join(rng.choice(list("etaoin"), 60)).encode()
    assert t.fold(short) == t.fold_long(short) or short in ranks


def test_byte_bpe_stems_and_tails():
    """Words met again, with and without punctuation behind them, in one call and in a later one, have tiktoken's ids."""
    import tiktoken

    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bytebpe.read_ranks(RANKS), special_tokens={})
    t = bytebpe.RankTokenizer(RANKS, P.PATTERN)
    for texts in (["end. end, don't!? end", None, "", " end.\n\nend  "], ["\tend end.;:", "don't. 12. caf\u00e9, caf\u00e9! \u00aa? 'll! end,"]):
        assert t.encode(texts) == [np.array(e.encode_ordinary(x or ""), "<u4").tobytes() for x in texts]


# ----------------------------------------------------------------- pipeline

def test_pipeline(spark):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == C.COLUMNS and 0 < out.count() <= docs.count(), name
        docs = spark.createDataFrame(out.collect(), out.schema)
    kept = {r.doc_id for r in docs.collect()}
    pieces = C.run(spark, SF_SMALL).toPandas()
    assert set(pieces.doc_id) == kept and (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()


def test_pipeline_stages_take_odd_rows(spark):
    import corpus_pipeline as C

    docs = odd(spark).select(*C.COLUMNS)
    for name, stage in C.STAGES:
        assert stage(spark, docs, SF_SMALL).count() >= 0, name
        assert stage(spark, empty(docs), SF_SMALL).count() == 0, name


def test_pipeline_verdicts_are_of_the_row(spark):
    """Null and repeated ids: a rejected row goes even if another row of its id stays; one row of a group stays."""
    import corpus_pipeline as C

    pd_docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("lang = 'en'").orderBy("doc_id")
    good = C.quality_rules(spark, pd_docs, SF_SMALL).orderBy("doc_id").limit(3).collect()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [tuple(r) for r in pd_docs.collect()]
    a, b = good[0].text, good[1].text
    odd_rows = [(None, a, "en", "s", 1), (None, "1234 5678", "en", "s", 2), (None, None, "en", "s", 3),
                (9001, b, None, "s", 4), (9001, "!!! ???", None, "s", 5), (9001, "", None, "s", 6)]
    docs = spark.createDataFrame(rows + odd_rows, schema)
    own = lambda out: sorted(r.n_chars for r in out.where("source = 's'").collect())
    named = C.language_id(spark, docs, SF_SMALL)
    assert own(named) == [1, 4] and named.where("n_chars = 4 and source = 's'").first().lang == "en"
    assert own(C.quality_rules(spark, docs.fillna({"lang": "en"}), SF_SMALL)) == [1, 4]
    c = good[2].text
    groups = [(None, a, "en", "x", 1), (None, a, "en", "y", 1), (None, b, "en", "x", 2), (5, b, "en", "x", 2), (5, b, "en", "x", 2), (4, b, "en", "x", 2),
              (4, b, "en", "x", 2), (5, c, "en", "x", 3), (5, c, "en", "x", 3), (None, c, "en", "x", 3)]
    out = C.near_duplicates(spark, spark.createDataFrame(groups, schema), SF_SMALL).collect()
    assert sorted((r.n_chars, r.doc_id) for r in out if r.n_chars > 1) == [(2, 4), (3, 5)] and len(out) == 3
