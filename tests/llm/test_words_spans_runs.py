"""Spelling variants, personal data and periodic runs against brute force, and on odd rows."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from leadsmith.llm import periodic, pii, queries, variants
from tests.conftest import SF_SMALL
from tests.llm.test_operators import TRICKY, empty, odd


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


# ----------------------------------------------------------------- periodic runs

def brute_runs(w):
    """Every lag's stretches of equal words, kept under the smallest period of the same stretch."""
    least = {}
    for q in range(1, len(w) // 3 + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                least.setdefault((i - q, j - i + q), q)
            i = j
    return sorted((s, n, q) for (s, n), q in least.items())


def brute_periodic(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if w and h % 10 == 0:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = brute_runs(w)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else None
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return (doc_id, len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4), sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def test_periodic_query(spark):
    docs = [d for d in documents(spark) if len((d[1] or "").split()) < 3000]
    want = {d[0]: brute_periodic(*d) for d in docs}
    got = {r[0]: tuple(r)[:8] for r in queries.op13_periodic_runs(spark, SF_SMALL).collect()}
    assert len(got) == len(documents(spark))
    assert {k: got[k] for k in want} == want
    assert any(r[1] for r in want.values())


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    w = []
    while len(w) < 400:
        unit = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, rng.choice([4, 12, 40])))]
        w += (unit * rng.randrange(1, 9))[:rng.randrange(1, 300)]
        if rng.random() < 0.3 and len(w) > 40:  # a period made of periods, with a slip
            w += (w[-30:] * 3)[:rng.randrange(60, 90)]
            w[rng.randrange(len(w))] = 7
    import numpy as np
    assert periodic.runs(np.array(w, np.int64)) == brute_runs(w)


def test_runs_at_the_borders():
    import numpy as np
    for q in range(1, 40):
        for n in (max(24, 3 * q) - 1, max(24, 3 * q), max(24, 3 * q) + 1):
            w = [-1, *(i % q for i in range(n)), -2]
            assert periodic.runs(np.array(w, np.int64)) == brute_runs(w) == ([(1, n, q)] if n >= max(24, 3 * q) else [])
    assert periodic.runs(np.zeros(1_000_000, np.int64)) == [(0, 1_000_000, 1)]
    with pytest.raises(ValueError):
        periodic.runs(np.zeros(30, np.int64), least=10)


def test_periodic_odd(spark):
    docs = odd(spark)
    for plant in (False, True):
        got = collections.Counter(tuple(r)[:8] for r in periodic.periodic_runs(docs, plant=plant).collect())
        if plant:
            assert got == collections.Counter(brute_periodic(r.doc_id, r.text) for r in docs.collect())
    assert any(r[2] == 0 and r[3] == 3000 and r[4] == 1 for r in got)  # "word " * 3000
    assert periodic.periodic_runs(empty(docs)).collect() == []


# ----------------------------------------------------------------- personal data

def brute_pii(text):
    text, out = text or "", {}
    out["email"] = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out["ip"] = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    def luhn(m):
        d = [int(x) for x in re.sub("[^0-9]", "", m.group())][::-1]
        return 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0
    out["card"] = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if luhn(m)]
    out["phone"] = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def base_row(doc_id, text):
    found = brute_pii(text)
    return (doc_id, *(len(found[k]) for k in pii.BASE), sha(",".join(f"{k}:{s}:{e}" for k in pii.BASE for s, e in found[k])))


def test_pii_query(spark):
    want = {d[0]: base_row(*d) for d in documents(spark)}
    got = {r.doc_id: r for r in queries.op12_pii_spans(spark, SF_SMALL).collect()}
    assert {k: tuple(r)[:6] for k, r in got.items()} == want
    assert all(sum(r[k][i] for r in [want]for k in want) for i in (1, 2, 3, 4))
    for d, text in documents(spark):
        base = {f"{k}:{s}:{e}" for k, own in brute_pii(text).items() for s, e in own}
        assert base <= set(filter(None, got[d].spans.split(",")))


@pytest.mark.parametrize("seed", range(40))
def test_pii_random(seed):
    rng = random.Random(seed)
    parts = ["a@b.c", "@", ".", "x.y", "1", "4111 1111 1111 1111", "+1 (555) 010-9999", "10.0.0.1", "256.1.1.1", "001.2.3.4", " ", "-", "é", "+", "(", "9", "%", "@d-e.f", "\n", "0"]
    for _ in range(200):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))
        found = [x for x in pii.spans(text) if x.kind in pii.BASE]
        want = brute_pii(text)
        assert [(x.kind, x.start, x.end) for x in found] == [(k, s, e) for k in pii.BASE for s, e in want[k]], text


def test_pii_further_kinds():
    def kinds(t):
        return [(x.kind, t[x.start:x.end]) for x in pii.spans(t)]
    assert kinds("Konto DE89 3704 0044 0532 0130 00 PLEASE") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("GB82WEST12345698765432") == [("iban", "GB82WEST12345698765432")]
    assert kinds("GB82WEST12345698765433") == []  # check digits
    assert kinds("pay by card 3782 822463 10005 now") == [("short_card", "3782 822463 10005")]
    assert kinds("item 3782 822463 10005 now") == []  # no word near
    assert kinds("my ssn is 219-09-9999.") == [("national_id", "219-09-9999")] and kinds("ssn 666-09-9999") == []
    assert kinds("call 020 7946 0958 today") == [("local_phone", "020 7946 0958")]
    assert kinds("order 020 7946 0958, call us") == []  # words for and against
    card = pii.spans("visa card 4111111111111111")[0]
    assert card.score > pii.spans("isbn 4111111111111111")[0].score > 0  # base spans stay at any score


def test_pii_long_texts_are_linear():
    n = 300_000
    for t in ("a" * n, "1" * n, "1." * n, "+1" + " " * n, "@" + "a" * n, "a@" * n, "1 " * n, "A" * n, "DE00" + "A1 " * n, "(1" * n, "+1-" * n):
        pii.spans(t)


def test_pii_odd(spark):
    docs = odd(spark)
    got = collections.Counter(tuple(r)[:6] for r in pii.personal_data(docs).collect())
    assert got == collections.Counter(base_row(r.doc_id, r.text) for r in docs.collect())
    assert pii.personal_data(empty(docs)).collect() == []
    kept = pii.found_in(docs.withColumn("text", F.lit("x a@b.de")), keep=["doc_id", "w"]).collect()
    assert {r["_row_w"] for r in kept} == {"clash"} and {r.spans[0].start for r in kept} == {2}


# ----------------------------------------------------------------- spelling variants

def brute_vocabulary(docs, misspelt):
    n = collections.Counter()
    for doc_id, text in docs:
        for w in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            if misspelt and doc_id is not None and h % misspelt == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(docs, misspelt=None):
    n = brute_vocabulary(docs, misspelt)
    groups = collections.defaultdict(set)  # one edit apart: equal after one deletion on one or both sides
    for w in n:
        for k in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            groups[k].add(w)
    near = collections.defaultdict(set)
    for own in groups.values():
        for a in own:
            near[a] |= {b for b in own if a != b and one_edit(a, b)}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 2 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def test_variants_query(spark):
    got = list(map(tuple, queries.op11_spelling_variants(spark, SF_SMALL).collect()))
    want = brute_variants(documents(spark), 97)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(r[1] for r in want) and any(r[1] and r[2] != r[1] for r in want)


@pytest.mark.parametrize("room", [variants.FILTER_BYTES, 1])
def test_variants_chains_and_long_words(spark, room):
    rng, long = random.Random(3), "ab" * 700
    some = ["".join(rng.choice("abÀÿ") for _ in range(rng.choice([4, 5, 6, 7, 70]))) for _ in range(250)]
    chain = ["aaaaaaa", "aaaaaab", "aaaaabb", "aaaabbb", "aaabbbb", "aabbbbb"]
    words = [w for w in some for _ in range(rng.randrange(1, 30))] + [w for k, w in enumerate(chain) for _ in range(40 * 2**k)]
    words += [long] * 3 + [long + "a"] * 9 + [long[:600] + "x" + long[601:]] * 6
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit("clash"))
    got = set(map(tuple, variants.variants(df, filter_bytes=room).collect()))
    assert got == brute_variants(rows)
    assert {r[2] for r in got if r[0] == "aaaaaaa"} == {r[2] for r in got if r[0] == "aabbbbb"}


def test_variants_filter_has_no_false_negative():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.choice([5, 6, 64, 90]))) for _ in range(4000)})
    import numpy as np
    layout = variants.Filter(collections.Counter(min(len(w), variants.LAST_SHARD) for w in words))
    bits = np.zeros(8 * layout.total, np.uint64)
    for own, codes in variants.by_length(words):
        keys = variants.keys_of([words[i] for i in own])
        for place, block in zip(variants.Filter.places(keys).T, [layout.block(keys, codes.shape[1])] * variants.BITS_SET):
            np.bitwise_or.at(bits, (block * np.uint64(8) + (place >> np.uint64(6))).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    for own, codes in variants.by_length(words):
        keys = variants.keys_of([words[i] for i in own])
        assert len(layout.hits(bits, 0, keys, codes.shape[1])) == len(keys)
        strange = variants.keys_of([words[i][:-1] + "z" for i in own])
        assert len(layout.hits(bits, 0, strange, codes.shape[1])) <= 0.02 * len(strange) + 3


def test_variants_keys_of_edits():
    import numpy as np
    alphabet = np.array(sorted(map(ord, "abcÿ")), np.uint32)
    for w in ("abcab", "aabbcÿ", "ab" * 50):
        points = np.array([[ord(c) for c in w]], np.uint32)
        made = sorted(int(k) for _, keys, _ in variants.edits(points, alphabet) for k in keys)
        edited = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in "abcÿ" if c > w[i]}
        assert made == sorted(map(int, variants.keys_of(sorted(edited))))


def test_variants_odd(spark):
    docs = odd(spark).unionByName(odd(spark)).unionByName(odd(spark))
    for misspelt in (None, 2):
        got = set(map(tuple, variants.variants(docs, misspelt=misspelt).collect()))
        assert got == brute_variants([(r.doc_id, r.text) for r in docs.collect()], misspelt)
    assert "q" * 5000 in {r[0] for r in map(tuple, variants.variants(docs).collect())} and TRICKY
    assert variants.variants(empty(docs)).collect() == []
