"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a word its encoding has a unique last token. An Aho-Corasick
automaton over the vocabulary gives, at each position, the tokens that end there;
the one that is compatible with the last token of the prefix before it is the last
token of this prefix. Following these back from the word's end gives the ids.

Two tokens are compatible when no merge across their border would have come before
the merges that made them: each side's symbols at the border, in the order in which
they were made, are its spine, and a merge of two spine symbols counts if neither
has been absorbed on its own side by then.
"""

from __future__ import annotations

import copy
import gc
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textloom.llm.common import with_made, with_several_made

#: Stands for the word-end marker in the automaton's alphabet, beside the 256 bytes.
END = "Ā"
#: Fixed values of the tokenizer file: its split pattern for words of Latin text.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+"
LATIN = re.compile("[!-~¡-ɏ]*")
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")
#: Entries of a cache's generation: the older of two goes when the newer is full, and what is used moves to the newer.
GENERATION = 150_000
NEVER = 1 << 30
#: Stands before a word; larger than any token.
START = (1 << 20) - 1
MOST_PAIRS = 400_000


def byte_chars() -> dict[str, str]:
    """The printable stand-in of each byte in byte-level vocabularies, to the byte as a character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): chr(b) for b in plain} | {chr(256 + i): chr(b) for i, b in enumerate(rest)}


class Cache(dict):
    """Two generations of made values; what both lack is made."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= GENERATION:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def strings_of(spec: dict) -> dict[int, str]:
    return {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}


class Decoder:
    def __init__(self, definition: str):
        self.strings = strings_of(json.loads(definition))

    def decode(self, ids: bytes | None) -> str:
        """The tokens' strings with a space between: the file names no decoder, and special tokens stay."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


class PrefixBpe:
    """One vocabulary; made once in each Python worker."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        model = spec["model"]
        # the library only cuts texts, for which it needs no vocabulary
        library = Tokenizer.from_str(json.dumps(spec | {"model": model | {"vocab": {}, "merges": []}, "added_tokens": [], "post_processor": None}))
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.suffix = model["end_of_word_suffix"] or ""
        self.strings = strings_of(spec)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {t: np.uint32(i).astype("<u4").tobytes() for t, i in special.items()}
        self.specials = re.compile("(" + "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.to_byte = byte_chars()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = model["vocab"]
        self.rank = {(ids[a], ids[b]): k for k, (a, b) in enumerate(merges)}
        self.made = {ids[a + b]: (ids[a], ids[b], k) for k, (a, b) in enumerate(merges)}
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        self.whole: set[int] = set()
        if max(self.strings) >= START:
            raise ValueError("a vocabulary of over a million tokens")
        for i in [i for i in ids.values() if i not in self.made] + list(self.made):  # parts before what is made of them
            if i in special.values():
                continue
            if i in self.made:
                a, b, k = self.made[i]
                if a not in self.whole or b not in self.whole or not self._apart(a, b, k):
                    continue  # merges of its parts come out otherwise: no encoding has this token
            if text := self._bytes(self.strings[i]):
                self.whole.add(i)
                self.automaton.add_word(text, (len(text), i))
        self.automaton.make_automaton()
        # found again for the tokens in use
        self.left.clear()
        self.right.clear()
        self.sizes = {i: n for n, i in self.automaton.values()}
        self.chunks, self.known = Cache(self._chunk), Cache(self._word)

    def fresh(self) -> PrefixBpe:
        """The same vocabulary with caches of its own, which go with it."""
        out = copy.copy(self)
        out.chunks, out.known = Cache(out._chunk), Cache(out._word)
        return out

    def _bytes(self, token: str) -> str:
        end = bool(self.suffix) and token.endswith(self.suffix)
        body = token[: len(token) - len(self.suffix)] if end else token
        return "".join(self.to_byte[c] for c in body) + END * end

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The token's symbols at its left (0) or right (1) border, each with the rank of the merge that absorbs it."""
        kept = (self.left, self.right)[side]
        if token not in kept:
            kept[token] = [(token, NEVER)]
            if token in self.made:
                kept[token] += [(t, min(k, self.made[token][2])) for t, k in self._spine(self.made[token][side], side)]
        return kept[token]

    def _apart(self, a: int, b: int, limit: int = NEVER) -> bool:
        """No merge across the border of a and b comes before what absorbs its two sides, or before limit."""
        rank = self.rank
        for x, until_x in self._spine(a, 1):
            for y, until_y in self._spine(b, 0):
                k = rank.get((x, y), NEVER)
                # equal ranks are merged from the left: an equal merge left of the border is earlier, one right of it later
                if k < limit and k < until_x and k <= until_y and k < NEVER:
                    return False
        return True

    def word(self, text: str) -> list[int]:
        """Ids of a word given as bytes in characters, its end marker included."""
        # last[i] is the last token of the prefix that ends at i; before the word, at -1, stands START, which fits all
        last: list[int] = [-1] * len(text) + [START]
        pairs = self.pairs
        for at, (size, token) in self.automaton.iter(text):
            if last[at] < 0:
                before = last[at - size]
                if before >= 0:
                    key = before << 20 | token
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= MOST_PAIRS:
                            pairs.clear()
                        fits = pairs[key] = before == START or self._apart(before, token)
                    if fits:
                        last[at] = token
        out, at, sizes = [], len(text) - 1, self.sizes
        while at >= 0:
            token = last[at]
            if token < 0:
                raise ValueError("the vocabulary lacks a byte of this word")
            out.append(token)
            at -= sizes[token]
        return out[::-1]

    def words(self, chunk: str) -> list[str]:
        """The pre-tokenizer's words of a chunk without white space, as bytes in characters."""
        if chunk.isalpha() and chunk.isascii():
            return [chunk.lower()]
        if LATIN.fullmatch(chunk) and unicodedata.is_normalized("NFC", chunk):
            low = "".join(c.lower() for c in chunk) if not chunk.isascii() else chunk.lower()
            if PLAIN.fullmatch(low):
                return [low.encode().decode("latin-1")]
            if low.isascii():
                return re.findall(WORD, low)
        split = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(chunk))
        return ["".join(self.to_byte[c] for c in w) for w, _ in split]

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; a null text has none."""
        if not text:
            return b""
        if any(t in text for t in self.special):
            return b"".join(self.special.get(s) or self._plain(s) for s in self.specials.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        # these four split a text for Python, but are ordinary characters to the tokenizer
        odd = "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text
        parts = re.split(r"[^\S\x1c-\x1f]+", text) if odd else text.split()
        return b"".join(map(self.chunks.__getitem__, parts))

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha() and chunk.isascii():
            low = chunk.lower()
            return self._word(chunk) if low == chunk else self.chunks[low]
        # a plain word is a chunk as well, so it is kept once
        return b"".join([self.chunks[w] if w.isalpha() and w.isascii() else self.known[w] for w in self.words(chunk)])

    def _word(self, word: str) -> bytes:
        ids = array("I", self.word(word + END if self.suffix else word))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


@lru_cache(maxsize=2)
def loaded(definition: str) -> PrefixBpe:
    made = PrefixBpe(definition)
    gc.freeze()  # its many tuples stay, so later collections needn't look at them
    return made


@lru_cache(maxsize=2)
def decoder(definition: str) -> Decoder:
    return Decoder(definition)


def definition_of(path: str) -> str:
    """The tokenizer file's text, read on the driver; its size is bounded, as it goes to every executor."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if len(text) > 64 << 20:
        raise ValueError("a tokenizer file of over 64 MB")
    return text


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", keep: bool = True) -> DataFrame:
    """Add the ids of each whole text as binary: little-endian unsigned 32-bit integers.

    Null and empty texts, and texts of white space, have no ids (empty binary). Special
    tokens' strings in a text are those tokens. Rows are kept as they are, repeated ones
    included; a column that is already named ``ids`` in any case is an error. Without
    ``keep`` the text column goes.
    """
    shared = df.sparkSession.sparkContext.broadcast(definition_of(path))
    return with_made(df, text, ids, T.BinaryType(), lambda: loaded(shared.value).fresh().encode, keep)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the decoded text of each row's ids; none for null or empty ids gives an empty text."""
    shared = df.sparkSession.sparkContext.broadcast(definition_of(path))
    return with_made(df, ids, text, T.StringType(), lambda: decoder(shared.value).decode)


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", keep: bool = True) -> DataFrame:
    """``encode`` and ``decode`` of its ids in one pass, so that neither texts nor ids move between two Python workers."""
    shared = df.sparkSession.sparkContext.broadcast(definition_of(path))

    def make() -> Callable[[str | None], tuple[bytes, str]]:
        there, back = loaded(shared.value).fresh().encode, decoder(shared.value).decode

        def one(value: str | None) -> tuple[bytes, str]:
            made = there(value)
            return made, back(made)

        return one

    return with_several_made(df, text, [(ids, T.BinaryType()), (decoded, T.StringType())], make, keep)
