"""Quality rules from tokeniser fertility.

Each whole text is measured with two public vocabularies over its words (runs of
non-space characters): a piece vocabulary with byte fallback gives characters per piece,
the share of byte-fallback pieces and the entropy of the text's pieces in bits; a
byte-level vocabulary gives characters per token.  A text is kept if every figure lies in
the band of its language, or of its script where the language has no band of its own,
and if it passes the base rules (at least ``MIN_WORDS`` words, at most half of them in
repeated three-word windows).

Words are measured once each and kept in a bounded per-worker table; the text is one Arrow
pass without a shuffle.  Defined results: a null or empty text has no words, all counts are
zero, the figures are null and it fails the base rules; repeated rows each get the same
answer; extra columns are ignored.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadsmith.llm.common import blocks, held, row_by_row
from leadsmith.llm.tokens import WordwiseTokenizer

MIN_WORDS = 50
#: Texts with over this share of words in repeated three-word windows fail the base rules.
MOST_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
#: Bands (lowest, highest) by script: characters per piece, byte-fallback share, entropy in bits, characters per byte token.
BANDS = {
    "latin": {"piece_chars": (1.3, 8.0), "fallback": (0.0, 0.10), "entropy": (4.5, 16.0), "byte_chars": (1.1, 8.0)},
    "cyrillic": {"piece_chars": (0.9, 6.0), "fallback": (0.0, 0.15), "entropy": (3.0, 16.0), "byte_chars": (0.4, 6.0)},
    "greek": {"piece_chars": (0.6, 6.0), "fallback": (0.0, 0.20), "entropy": (3.0, 16.0), "byte_chars": (0.3, 6.0)},
    "arabic": {"piece_chars": (0.6, 6.0), "fallback": (0.0, 0.20), "entropy": (3.0, 16.0), "byte_chars": (0.3, 6.0)},
    "han": {"piece_chars": (0.2, 4.0), "fallback": (0.0, 0.80), "entropy": (3.0, 16.0), "byte_chars": (0.2, 4.0)},
    "other": {"piece_chars": (0.2, 8.0), "fallback": (0.0, 0.90), "entropy": (3.0, 16.0), "byte_chars": (0.2, 8.0)},
}
#: Bands of languages that differ from their script's.
LANGUAGE_BANDS = {
    "en": {"piece_chars": (1.95, 8.0), "byte_chars": (2.05, 8.0)},
    "de": {"piece_chars": (1.90, 9.0), "byte_chars": (1.86, 9.0)},
    "fr": {"piece_chars": (1.75, 8.0), "byte_chars": (1.70, 8.0)},
    "es": {"piece_chars": (1.75, 8.0), "byte_chars": (1.63, 8.0)},
}
#: Code point ranges of the scripts that have bands.
SCRIPTS = [("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("arabic", 0x600, 0x6FF),
           ("han", 0x3040, 0x30FF), ("han", 0x4E00, 0x9FFF), ("han", 0xAC00, 0xD7AF)]
SCRIPT_NAMES = list(dict.fromkeys(name for name, _, _ in SCRIPTS))
#: Distinct words are encoded in groups of this many.
AT_ONCE = 16384
#: Words, and their characters, that a worker keeps at most; words beyond them are measured again when met.
MOST_WORDS, MOST_CHARS = 700_000, 32_000_000


def filled(column: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    """``more`` written behind the first n entries of a column, which grows by half when it is full."""
    if n + len(more) > len(column):
        column = np.concatenate([column[:n], np.zeros((max(len(more), n // 2 + 1024), *column.shape[1:]), column.dtype)])
    column[n:n + len(more)] = more
    return column


class Words:
    """Numbers words met by a worker and keeps their figures as columns by that number."""

    def __init__(self, piece_path: str, byte_path: str):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.is_byte = np.fromiter((self.pieces.is_byte(i) for i in range(len(self.pieces))), bool)
        self.byte_level = WordwiseTokenizer(byte_path, "byte_level")
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint16 if len(self.pieces) <= 1 << 16 else np.uint32)  # pieces of all words, one after another
        self.first = np.zeros(0, np.int64)
        #: characters, pieces, byte-fallback pieces, byte-level tokens, letters of each script
        self.figures = np.zeros((0, 4 + len(SCRIPT_NAMES)), np.int32)
        self.n_ids = self.n_chars = 0

    def _add(self, part: list[str]) -> None:
        own = self.pieces.encode(part, num_threads=1)
        lengths = np.fromiter(map(len, own), np.int64, len(own))
        flat = np.fromiter(chain.from_iterable(own), np.uint32, int(lengths.sum()))
        fell, ends = np.concatenate([[0], np.cumsum(self.is_byte[flat])]), np.cumsum(lengths)
        chars = np.fromiter(map(len, part), np.int64, len(part))
        n = len(self.number)
        self.first = filled(self.first, n, self.n_ids + ends - lengths)
        self.figures = filled(self.figures, n, np.column_stack([chars, lengths, fell[ends] - fell[ends - lengths],
                                                               self.byte_level.count_words(part), letters_by_script(part, chars)]))
        self.ids = filled(self.ids, self.n_ids, flat)
        self.number.update(zip(part, range(n, n + len(part))))
        self.n_ids, self.n_chars = self.n_ids + len(flat), self.n_chars + int(chars.sum())

    def measured(self, texts: list[str | None], split: list[list[str]]) -> list[tuple]:
        """The figures of texts, of which ``split`` holds the words; new words are measured first."""
        before = len(self.number), self.n_ids, self.n_chars
        fresh = list(set().union(*split).difference(self.number))
        for part in blocks(fresh, AT_ONCE):
            self._add(part)
        rows = [_measure(t, np.fromiter(map(self.number.__getitem__, s), np.int64, len(s)), self) for t, s in zip(texts, split)]
        if len(self.number) > MOST_WORDS or self.n_chars > MOST_CHARS:
            for w in fresh:
                del self.number[w]
            _, self.n_ids, self.n_chars = before
        return rows


def letters_by_script(words: list[str], chars: np.ndarray) -> np.ndarray:
    """Letters of each script per word (of so many characters)."""
    c = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum(chars) - chars
    out = np.zeros((len(words), len(SCRIPT_NAMES)), np.int64)
    for name, lo, hi in SCRIPTS:
        out[:, SCRIPT_NAMES.index(name)] += np.add.reduceat((c >= lo) & (c <= hi), starts, dtype=np.int64)
    return out


def script_of(letters: np.ndarray, chars: int) -> str:
    """Script with most letters among a text's distinct words."""
    best = int(letters.argmax())
    if letters[best] * 2 > chars or letters[best] and SCRIPT_NAMES[best] != "latin":
        return SCRIPT_NAMES[best]
    return "latin" if letters[SCRIPT_NAMES.index("latin")] else "other"


def repeat_words(codes: np.ndarray, distinct: int) -> int:
    """Words in three-word windows found twice or more, the first included."""
    if len(codes) < 4:
        return 0
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    key = (a * distinct + b) * distinct + c if distinct < 2_000_000 else np.unique(np.stack([a, b, c], 1), axis=0, return_inverse=True)[1].ravel()
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    covered = np.zeros(len(codes), bool)
    covered[at] = covered[at + 1] = covered[at + 2] = True
    return int(covered.sum())


def _measure(text: str | None, codes: np.ndarray, words: Words) -> tuple:
    text = text or ""
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    own, times = np.unique(codes, return_counts=True)
    figures = words.figures[own].astype(np.int64)
    chars, total, fallback, tokens = (int((times * figures[:, i]).sum()) for i in range(4))
    base = (len(codes), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(codes, len(words.number)))
    if not len(codes):
        return *base, None, None, None, None, "none"
    per_word = figures[:, 1]
    at = np.repeat(words.first[own] - (np.cumsum(per_word) - per_word), per_word) + np.arange(int(per_word.sum()))
    seen = np.bincount(words.ids[at], weights=np.repeat(times, per_word))
    p = seen[seen > 0] / max(1, total)
    return (*base, chars / max(1, total), fallback / max(1, total), float(-(p * np.log2(p)).sum()) + 0.0,
            chars / max(1, tokens), script_of(figures[:, 4:].sum(axis=0), int(figures[:, 0].sum())))


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "piece_chars double, fallback double, entropy double, byte_chars double, script string")


def fertility(docs: DataFrame, piece_path: str, byte_path: str, id_col: str = "doc_id", keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Base counts and fertility figures per row, and the columns ``keep`` of the row as _row_<name>."""
    def run(b: pd.DataFrame) -> pd.DataFrame:
        known = held(f"fertility {piece_path} {byte_path}", lambda: Words(piece_path, byte_path))
        # words as bytes.split() finds them: ASCII space only
        split = [(t or "").encode("utf-8", "surrogatepass").split() for t in b["t"]]
        split = [b" ".join(s).decode("utf-8", "surrogatepass").split(" ") if s else [] for s in split]
        rows = known.measured(list(b["t"]), split)
        return pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                           "piece_chars", "fallback", "entropy", "byte_chars", "script"])
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    out = row_by_row(docs.withColumns({"_id": F.col(id_col).cast("long"), "_lang": lang}), {"t": "text"}, run, SCHEMA, ["_id", "_lang", *keep])
    return out.withColumnsRenamed({"_row__id": "doc_id", "_row__lang": "lang"}).select(
        "doc_id", *T.StructType.fromDDL(SCHEMA).names, "lang", *[f"_row_{c}" for c in keep])


def in_band(figure: str):
    """Whether a figure lies in the band of the row's language or else script."""
    c, out = F.col(figure), None
    for lang, own in LANGUAGE_BANDS.items():
        if figure in own:
            test = (F.col("lang") == lang) & (F.col("script") == "latin")
            out = out.when(test, c.between(*own[figure])) if out is not None else F.when(test, c.between(*own[figure]))
    for script, own in BANDS.items():
        test = F.col("script") == script
        out = out.when(test, c.between(*own[figure])) if out is not None else F.when(test, c.between(*own[figure]))
    return F.coalesce(out, F.lit(False))


def quality(docs: DataFrame, piece_path: str, byte_path: str, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Base counts, base_failed, kept, the figures with the verdict of each band, and the columns ``keep`` as _row_<name>."""
    f = fertility(docs, piece_path, byte_path, keep=keep)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    bands = {x: in_band(x) for x in ("piece_chars", "fallback", "entropy", "byte_chars")}
    verdict = F.lit(True)
    for b in bands.values():
        verdict = verdict & b
    return f.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & verdict).alias("kept"),
                    "script", "piece_chars", "fallback", "entropy", "byte_chars",
                    *[b.alias(f"{x}_ok") for x, b in bands.items()], *[f"_row_{c}" for c in keep])
