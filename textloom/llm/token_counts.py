"""Token counts: greedy longest-match word pieces counted by a linear automaton."""

from __future__ import annotations

import json
import unicodedata
from collections import deque
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textloom.llm.bpe import byte_chars, definition_of
from textloom.llm.common import with_made

CACHED_WORDS = 200_000


class PieceCounter:
    """The trie of a vocabulary, with failure links and popped-token counts.

    At a node whose string s has no child for the next character, greedy matching would
    by now have given off its longest piece of s, and the next pieces of the rest, as far
    as they are sure. ``pops`` is their number, and ``fail`` the node of what is left of
    s, so each character is read once and no piece is built. ``fail`` is None where what
    is left starts no piece: the word is then one unknown piece.
    """

    def __init__(self, pieces: Iterable[str], continuing: str = ""):
        first, rest = set(), set()
        for p in pieces:
            if p:
                (rest if continuing and p.startswith(continuing) else first).add(p)
        self.next: list[dict[str, int]] = [{}]
        self.whole: list[bool] = [False]
        self.root = 0
        self.inner = self._node(continuing) if continuing else 0
        for p in sorted(first | rest):
            self.whole[self._node(p)] = True
        self.fail: list[int | None] = [None] * len(self.next)
        self.pops = [0] * len(self.next)
        todo = deque([self.root, self.inner] if self.inner != self.root else [self.root])
        seen = set(todo)
        while todo:
            u = todo.popleft()
            for c, v in self.next[u].items():
                if v in seen:
                    continue
                seen.add(v)
                if self.whole[v]:
                    self.fail[v], self.pops[v] = self.inner, 1
                else:
                    z, n = self.fail[u], self.pops[u]
                    while z is not None and c not in self.next[z]:
                        n += self.pops[z]
                        z = self.fail[z]
                    if z is not None:
                        self.fail[v], self.pops[v] = self.next[z][c], n
                todo.append(v)

    def _node(self, text: str) -> int:
        at = 0
        for c in text:
            if c not in self.next[at]:
                self.next[at][c] = len(self.next)
                self.next.append({})
                self.whole.append(False)
            at = self.next[at][c]
        return at

    def count(self, word: str) -> int:
        """Pieces of a word; 1 if some character starts none; 0 for an empty word."""
        nexts, fail, pops = self.next, self.fail, self.pops
        at, n = self.root, 0
        for c in word:
            while c not in nexts[at]:
                n += pops[at]
                at = fail[at]
                if at is None:
                    return 1
            at = nexts[at][c]
        while at != self.inner and at != self.root:
            n += pops[at]
            at = fail[at]
            if at is None:
                return 1
        return n


def words_of(text: str | None) -> list[str]:
    """Lower-cased NFC words between white space, cut where letters, digits and other signs meet."""
    out = []
    for chunk in unicodedata.normalize("NFC", text or "").lower().split():
        if chunk.isalpha():
            out.append(chunk)
            continue
        start, last = 0, None
        for i, c in enumerate(chunk):
            kind = 0 if c.isalpha() else 1 if c.isdigit() else 2
            if last is not None and kind != last:
                out.append(chunk[start:i])
                start = i
            last = kind
        out.append(chunk[start:])
    return out


@lru_cache(maxsize=2)
def loaded(definition: str) -> PieceCounter:
    """The counter of a tokenizer file's pieces without their word-end mark."""
    model = json.loads(definition)["model"]
    end = model.get("end_of_word_suffix") or ""
    mark = model.get("continuing_subword_prefix") or ""
    return PieceCounter({p.removesuffix(end) if end else p for p in model["vocab"]}, mark)


@lru_cache(maxsize=1)
def _stand_ins() -> dict[int, str]:
    return {ord(b): c for c, b in byte_chars().items()}


def counter(definition: str):
    """(words, pieces) of a text; the chunks between white space are remembered."""
    automaton, known = loaded(definition), {}
    to = _stand_ins()

    def pieces(chunk: str) -> tuple[int, int]:
        words = words_of(chunk)
        return len(words), sum(automaton.count(w.encode("utf-8", "surrogatepass").decode("latin-1").translate(to)) for w in words)

    def count(text: str | None) -> dict[str, int]:
        n = m = 0
        for chunk in (text or "").split():
            found = known.get(chunk)
            if found is None:
                if len(known) >= CACHED_WORDS:
                    known.clear()
                found = known[chunk] = pieces(chunk)
            n += found[0]
            m += found[1]
        return {"n_words": n, "n_tokens": m}

    return count


def token_counts(docs: DataFrame, path: str, text: str = "text", into: str = "counts") -> DataFrame:
    """Add a struct of n_words and n_tokens of each whole text; both 0 for null, empty and blank texts.

    ``path`` is a tokenizer file whose vocabulary is of byte-level strings. Rows and
    columns stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition_of(path))
    kind = T.StructType.fromDDL("n_words bigint, n_tokens bigint")
    return with_made(docs, text, into, kind, lambda: counter(shared.value))
