"""Whole texts to token ids with the tokenizers library, each distinct word encoded once per worker.

A text is cut only where the tokeniser itself cannot join: before a space or line break
between two other characters (byte-level), or at a space or line break (word vocabulary,
which drops white space).  Words not met before are encoded together in a few calls and kept
in a bounded cache.  In such a call byte-level words follow each other as in a text: only the
first token of each starts with its space or line break.  Words of the word vocabulary are parted
by a control character between spaces, which is one token.  Words at which that could not be told
are parted by a special token.  Strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

from leadsmith.llm.common import blocks, forget, held

#: White space as Unicode defines it (the tokenisers' definition).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUN = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
PARTING = "<|endoftext|>"
#: Parts words of the word vocabulary.
CONTROL = "\x01"
#: Characters that stand for a space and a line break in byte-level vocabularies.
SPACE_SIGN, BREAK_SIGN = "\u0120", "\u010a"
#: Punctuation at a word's end, after a letter, has tokens of its own in both kinds.
TAIL = ".,;:!?"
#: The usual word: Latin letters and such punctuation.
PLAIN = re.compile(f"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)[{TAIL}]*")
#: Words encoded in one call.
AT_ONCE = 2048
#: Words longer than this many characters are not kept.
LONGEST = 64


class Words(dict):
    """Ids by word.  A word that is asked for and not there gets a place that is filled once all words
    of the texts at hand are known, so that each occurrence is looked up once."""

    def __init__(self, safe: Callable[[str], bool]):
        self.safe, self.fresh, self.unsafe = safe, {}, 0

    def __missing__(self, key: str) -> bytearray | bytes:
        if not self.safe(key):
            self.unsafe += 1  # this text needs the exact cut
            return b""
        held = self[key] = self.fresh[key] = bytearray()
        return held


class WordwiseTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes; ``kind``: byte_level or word."""

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        self.parting = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.parting_id = self.parting.token_to_id(PARTING)
        self.kind, self.cache = kind, Words(self._safe)
        if kind == "word":
            self.control = self.plain.encode(CONTROL, add_special_tokens=False).ids
        else:
            vocabulary = self.plain.get_vocab()
            self.starts = np.zeros(max(vocabulary.values()) + 1, bool)
            self.starts[[i for t, i in vocabulary.items() if t[0] in (SPACE_SIGN, BREAK_SIGN)]] = True

    def _literal(self, key: str) -> str:
        if self.kind == "word":
            return key
        return key[1:] if key[0] == "\t" else key if key[0] == "\n" else " " + key

    def _keys(self, text: str) -> list[str]:
        """Cache keys whose literals make up the text.  Byte-level: a leading tab marks a literal as it stands."""
        if self.kind == "word":
            try:  # A-Z in lower case, where no combining mark can follow them
                text = text.encode("latin-1").lower().decode("latin-1")
            except UnicodeEncodeError:
                pass
            return text.replace("\n", " ").split(" ")
        keys = text.replace("\n", " \n").split(" ")
        if not keys[0]:
            return keys[1:]
        # the first word has no space before it; white space at its ends needs the exact cut
        keys[0] = "\t" + keys[0] if keys[0] == keys[0].strip() else ""
        return keys

    def _exact_keys(self, text: str) -> list[str]:
        return ["\t" + x for x in RUN.findall(text)]

    def _safe(self, key: str) -> bool:
        """Whether a key starts and ends as cuts need it (other white space or none left in between)."""
        if PLAIN.fullmatch(key) or self.kind == "word" or key[:1] == "\t":
            return True
        inner = key[1:] if key[:1] == "\n" else key
        return bool(inner) and inner == inner.strip()

    def _follows(self, key: str) -> bool:
        """Whether a word may stand among others in a call and be told by its tokens."""
        if PLAIN.fullmatch(key):
            return True
        if "<|" in key or not key:
            return False
        return CONTROL not in key if self.kind == "word" else key[0] != "\t" and " " not in key and self._safe(key)

    def _cuts(self, part: list[str]) -> tuple[np.ndarray, np.ndarray, int] | None:
        """Ids of words encoded in a row, where each word's ids end, and the ids between words; None if it cannot be told."""
        if self.kind == "word":
            if len(self.control) != 1:
                return None
            ids = np.array(self.plain.encode_batch_fast([f" {CONTROL} ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.append(np.flatnonzero(ids == self.control[0]), len(ids))
            return (ids, ends, 1) if len(ends) == len(part) else None
        ids = np.array(self.plain.encode_batch_fast(["".join(map(self._literal, part))], add_special_tokens=False)[0].ids, np.uint32)
        first = np.flatnonzero(self.starts[ids])
        return (ids, np.append(first[1:], len(ids)), 0) if len(first) == len(part) and first[0] == 0 else None

    def _ids(self, text: str) -> bytes:
        """Ids of a text as it stands, on its own."""
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _encoded(self, keys: list[str]) -> dict[str, bytes]:
        out = {}

        def take(part: list[str], ids: np.ndarray, ends: np.ndarray, between: int) -> None:
            raw, start = ids.tobytes(), 0
            for key, end in zip(part, (4 * ends).tolist()):
                out[key] = raw[start:end]
                start = end + 4 * between
        for part in blocks([k for k in keys if self._follows(k)], AT_ONCE):
            if found := self._cuts(part):
                take(part, *found)
        for part in blocks([k for k in keys if k not in out and "<|" not in k and self._literal(k)], AT_ONCE):
            ids = np.array(self.parting.encode_batch_fast([PARTING.join(map(self._literal, part))], add_special_tokens=False)[0].ids, np.uint32)
            take(part, ids, np.append(np.flatnonzero(ids == self.parting_id), len(ids)), 1)
        for key in keys:
            if key not in out:
                out[key] = self._ids(self._literal(key)) if key else b""
        return out

    def _stem(self, key: str) -> str:
        """The word without punctuation behind its last letter; the word vocabulary has no capitals."""
        if plain := PLAIN.fullmatch(key):
            return plain[1] if self.kind != "word" or not key.isascii() else plain[1].lower()
        stem = key.rstrip(TAIL)
        if not (stem and stem[-1].isalpha() and stem[-1] < "\u0250" and stem[0] not in "\t\n"):
            return key
        return stem.lower() if self.kind == "word" and stem.isascii() else stem

    def _fill(self, fresh: dict[str, bytearray]) -> list[str]:
        """Put ids in place for words just met, each from its stem and tail; the entries that are new."""
        stem_of = {k: self._stem(k) for k in fresh}
        found = self._encoded([s for s in dict.fromkeys(stem_of.values()) if s in fresh or s not in self.cache])
        tail_ids = {t: self._ids(t) for t in {k[len(s):] for k, s in stem_of.items()}}
        for k, s in stem_of.items():
            fresh[k] += (found[s] if s in found else self.cache[s]) + tail_ids[k[len(s):]]
        more = {s: v for s, v in found.items() if s not in fresh}
        self.cache.update(more)
        return [*fresh, *more]

    def count_words(self, words: list[str]) -> np.ndarray:
        """Number of ids of words that follow a space, each on its own (not kept)."""
        stems = list(map(self._stem, words))
        tails = [w[len(s):] for w, s in zip(words, stems)]
        tail = {t: len(self.plain.encode(t, add_special_tokens=False).ids) for t in set(tails)}
        different = list(dict.fromkeys(stems))
        number = dict(zip(different, self._counts(different).tolist()))
        return np.fromiter((number[s] + tail[t] for s, t in zip(stems, tails)), np.int64, len(words))

    def _counts(self, words: list[str]) -> np.ndarray:
        out, rest = np.zeros(len(words), np.int64), []
        for part in blocks(list(enumerate(words)), AT_ONCE):
            own = [(i, w) for i, w in part if self._follows(w)]
            found = self._cuts([w for _, w in own]) if own else None
            if found:
                _, ends, between = found
                out[[i for i, _ in own]] = np.diff(ends, prepend=-between) - between
            rest += [x for x in part if not found or not self._follows(x[1])]
        ids = self._encoded([w for _, w in rest])
        for i, w in rest:
            out[i] = len(ids[w]) // 4
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        parts, cache = [], self.cache
        for t in texts:
            keys, unsafe = self._keys(t) if t else [], cache.unsafe
            own = list(map(cache.__getitem__, keys))
            if cache.unsafe != unsafe:
                own = list(map(cache.__getitem__, self._exact_keys(t)))
            parts.append(own)
        fresh, cache.fresh = cache.fresh, {}
        new = self._fill(fresh)
        out = list(map(b"".join, parts))
        for k, ids in fresh.items():
            cache[k] = bytes(ids)
        forget(cache, new, LONGEST)
        return out


def tokenizer(path: str, kind: str) -> WordwiseTokenizer:
    """The worker's tokeniser (with its cache) of a file and kind."""
    return held(f"tokens {kind} {path}", lambda: WordwiseTokenizer(path, kind))
