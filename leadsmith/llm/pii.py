r"""Personal data in texts: patterns propose spans, validators confirm them, context words adjust the score.

Patterns run leftmost and without overlap per kind; a proposal that fails its validator is
dropped and not tried again.  Every span starts from the score of its kind, a passed checksum
adds to it, and words of the ``NEAR`` words before and the ``AFTER`` words after the span raise
or lower it.  Kinds of the base set (``email``, ``ip``, ``card``, ``phone``) are spans whatever
their score; the further kinds need ``THRESHOLD``:

* ``iban``: country, check digits and account, mod-97 over the whole, country letters of two
  capitals; of a proposal with groups the longest run of groups that passes;
* ``short_card``: 13 to 15 digits that pass Luhn, near a card word;
* ``national_id``: 3-2-4 digits with ranges that were given out, near a word for such a number;
* ``local_phone``: 8 to 15 digits in groups without a plus, near a word for a telephone.

Further kinds are not proposed inside a span found before.  All patterns take linear time on
any text: runs are entered at their start alone, and the local part of an address is read
backwards from its @.

One Arrow pass, no shuffle, whole texts.  Defined results: a null text is empty and has no
span; repeated rows each get the same answer; a null id stays null; extra columns are ignored
unless named in ``keep``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadsmith.llm.common import row_by_row

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "short_card", "national_id", "local_phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
GROUPS = re.compile(r"(?<![0-9+.-])\(?[0-9]{2,5}\)?(?:[ .-][0-9]{2,5}){1,5}(?![0-9])")
WORD = re.compile(r"[^\W\d_]+")

#: Scores: where a kind starts, what a passed checksum adds, what one context word adds or takes away (once each).
START = {"email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.4, "short_card": 0.1, "national_id": 0.2, "local_phone": 0.2}
CHECKSUM, FOR, AGAINST, THRESHOLD = 0.4, 0.4, 0.3, 0.6
#: Words before and after a span that count as near it, and the characters they are looked for in.
NEAR, AFTER, REACH = 6, 3, 80
#: Words that speak for a kind, in the languages of the texts.
CONTEXT = {
    "email": {"email", "mail", "contact", "kontakt", "courriel", "correo"},
    "ip": {"ip", "host", "address", "adresse", "dirección", "server"},
    "card": {"card", "visa", "mastercard", "karte", "kreditkarte", "carte", "tarjeta"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "anruf", "téléphone", "teléfono", "móvil"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "national_id": {"ssn", "social", "security", "identity"},
}
CONTEXT |= {"short_card": CONTEXT["card"], "local_phone": CONTEXT["phone"]}
#: Words that speak against a number being personal.
OTHERWISE = {"isbn", "order", "invoice", "version", "build", "serial", "article", "rechnung", "facture", "pedido", "factura"}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(number: str) -> bool:
    """Whether the digits pass the Luhn check."""
    d = list(map(int, reversed(number)))
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number (letters count as 10 to 35) passes mod-97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The longest local part before each @ that a domain follows, not reaching into the match before."""
    free = 0
    for m in DOMAIN.finditer(text):
        at = start = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            free = m.end()
            yield start, free


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield m.span()


def cards(text: str, least: int = 16, most: int = 19) -> Iterator[tuple[int, int]]:
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= least and least <= len(d := digits(m.group())) <= most and luhn(d):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 8 <= len(digits(m.group())) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in IBAN.finditer(text):
        # whole groups go from the end until the check passes
        ends = [m.end(), *(m.start() + i for i in range(m.end() - m.start() - 1, 14, -1) if m.group()[i] == " ")]
        for end in ends:
            account = text[m.start():end].replace(" ", "")
            if 15 <= len(account) <= 34 and mod97(account):
                yield m.start(), end
                break


def national_ids(text: str) -> Iterator[tuple[int, int]]:
    for m in NATIONAL.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def local_phones(text: str) -> Iterator[tuple[int, int]]:
    for m in GROUPS.finditer(text):
        if 8 <= len(digits(m.group())) <= 15:
            yield m.span()


#: What proposes each kind, its validator included.
PROPOSE: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans,
    "short_card": lambda t: cards(t, 13, 15), "national_id": national_ids, "local_phone": local_phones}
CHECKED = {"card", "short_card", "iban"}


def score(text: str, kind: str, start: int, end: int) -> float:
    """Score of a confirmed span from its kind, its checksum and the words near it."""
    before = WORD.findall(text[max(0, start - REACH):start].lower())[-NEAR:]
    near = {*before, *WORD.findall(text[end:end + REACH].lower())[:AFTER]}
    s = START[kind] + CHECKSUM * (kind in CHECKED) + FOR * bool(near & CONTEXT[kind]) - AGAINST * bool(near & OTHERWISE)
    return round(min(1.0, max(0.0, s)), 2)


def spans(text: str | None, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a text by kind as listed, then start (code points, end exclusive)."""
    found: list[Span] = []
    if not text or not re.search(r"[0-9@]", text):
        return found
    taken: list[tuple[int, int]] = []
    for kind in KINDS:
        own = [Span(kind, s, e, score(text, kind, s, e)) for s, e in PROPOSE[kind](text)]
        if kind not in BASE:
            own = [x for x in own if x.score >= threshold]
            if own and taken:
                own = _outside(own, sorted(taken))
        found += own
        taken += [(x.start, x.end) for x in own]
    return found


def _outside(own: list[Span], taken: list[tuple[int, int]]) -> list[Span]:
    """Spans (by start) that meet none of the taken stretches (by start, which may overlap)."""
    out, i, reach = [], 0, 0
    for x in own:
        while i < len(taken) and taken[i][0] < x.end:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= x.start:
            out.append(x)
    return out


def listed(found: list[Span]) -> str:
    return ",".join(f"{x.kind}:{x.start}:{x.end}" for x in found)


def found_in(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """One row per input row: ``spans`` (array of kind, start, end, score) and the columns ``keep`` as _row_<name>."""
    def run(b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"spans": [[x._asdict() for x in spans(t, threshold)] for t in b["t"]]})
    return row_by_row(docs, {"t": text_col}, run, "spans array<struct<kind: string, start: int, end: int, score: double>>", keep)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans per base kind, digest of the base spans, all spans, their scores and the number of further ones."""
    def run(b: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for t in b["t"]:
            found = spans(t)
            base = [x for x in found if x.kind in BASE]
            rows.append((*(sum(x.kind == k for x in base) for k in BASE), hashlib.sha256(listed(base).encode()).hexdigest(), listed(found),
                         ",".join(f"{x.score:.2f}" for x in found), len(found) - len(base)))
        return pd.DataFrame(rows, columns=[f"n_{k}" for k in BASE] + ["base_sha256", "spans", "scores", "n_further"])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string, scores string, n_further long"
    return row_by_row(rows, {"t": "text"}, run, schema, ["id"]).withColumnRenamed("_row_id", "doc_id").select(
        "doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans", "scores", "n_further")
