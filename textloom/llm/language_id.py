"""Language identification by error-correcting output codes over character n-grams."""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textloom.llm.common import with_made

#: Buckets of hashed n-grams of these lengths; the documents that training takes at most, over all languages.
BUCKETS_LOG2, LENGTHS, MOST_TRAINED = 12, (1, 2, 3, 4), 2400
MOST_LANGUAGES = 1000
UNDETERMINED = "und"
#: A prediction is ambiguous if its share of the decoded scores is below this.
AMBIGUOUS = 0.5
PIECE = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def features(text: str | None) -> np.ndarray | None:
    """Square roots of the shares of hashed n-grams of letters, with one space for all between; None without letters."""
    if not text:
        return None
    low = text.lower()
    counts = np.zeros(1 << BUCKETS_LOG2, np.int64)
    found = False
    for at in range(0, len(low), PIECE):  # very long texts go piece by piece
        points = np.frombuffer(low[at : at + PIECE + LENGTHS[-1] - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[points]
        found = found or bool(letter[:PIECE].any())
        points = np.where(letter, points, 32)
        keep = letter.copy()
        keep[0] = True
        keep[1:] |= letter[:-1]
        points = points[keep]
        h = np.zeros(len(points), np.uint32)
        for n in range(1, LENGTHS[-1] + 1):
            if len(points) < n:
                break
            h = h[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1 :] + np.uint32(n)
            if n in LENGTHS:
                counts += np.bincount((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS_LOG2), minlength=len(counts))
    if not found:
        return None
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """A row of -1 and 1 for each of k classes.

    All different splits of the classes up to five of them; else the random code, of
    several, whose two nearest words are farthest apart.
    """
    if k <= 1:
        return np.zeros((k, 0), np.int8)
    if k <= 5:
        splits = range(2 ** (k - 1) - 1)
        return np.array([[1 if c == 0 or not (s >> (c - 1)) & 1 else -1 for s in (2 ** (k - 1) - 1 - x for x in splits)] for c in range(k)], np.int8)
    bits, rng, best = max(15, 6 * (k - 1).bit_length()), np.random.default_rng(seed), None
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (k, bits))
        apart = (bits - code.astype(int) @ code.T.astype(int)) // 2 + bits * np.eye(k, dtype=int)
        if np.abs(code.sum(axis=0)).max() < k and (best is None or apart.min() > best[0]):
            best = (apart.min(), code)
    return best[1]


@dataclass
class Model:
    labels: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    #: how far each class trusts each bit; rows sum to 1
    trust: np.ndarray

    def decode(self, margins: np.ndarray) -> tuple[str, float, bool]:
        """The label of the codeword with the least weighted logistic loss, its share, and whether that is ambiguous."""
        loss = (self.trust * np.logaddexp(0, -self.code * margins)).sum(axis=1) * max(1, self.code.shape[1])
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        best = int(share.argmax())
        return self.labels[best], float(share[best]), bool(share[best] < AMBIGUOUS)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        x = features(text) if self.labels else None
        if x is None:
            return UNDETERMINED, 0.0, True
        return self.decode(x @ self.weights + self.bias)


def fit(x: np.ndarray, y: np.ndarray, labels: list[str], steps: int = 250, decay: float = 1e-4) -> Model:
    """One logistic classifier a code bit, by accelerated gradient steps; each language weighs the same."""
    code = codewords(len(labels))
    bits = code.shape[1]
    w, b = np.zeros((x.shape[1], bits), np.float32), np.zeros(bits, np.float32)
    if not bits:
        return Model(labels, code, w, b, np.zeros((len(labels), 0)))
    target = code[y].astype(np.float32)
    weight = (1 / np.bincount(y, minlength=len(labels))[y] / len(labels)).astype(np.float32)[:, None]
    rate = np.float32(8.0)  # rows have length 1, so the curvature is at most a quarter and the bias's
    ahead_w, ahead_b = w, b
    for i in range(steps):
        slope = -weight * target / (1 + np.exp(target * (x @ ahead_w + ahead_b)))
        new_w = ahead_w - rate / 2 * (x.T @ slope + np.float32(decay) * ahead_w)
        new_b = ahead_b - rate / 2 * slope.sum(axis=0)
        push = np.float32(i / (i + 3))
        ahead_w, ahead_b = new_w + push * (new_w - w), new_b + push * (new_b - b)
        w, b = new_w, new_b
    right = (np.sign(x @ w + b) == target).astype(float)
    trust = np.array([right[y == c].mean(axis=0) for c in range(len(labels))]) + 1e-3
    return Model(labels, code, w, b, trust / trust.sum(axis=1, keepdims=True))


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", most: int = MOST_TRAINED) -> Model:
    """Fit on at most ``most`` labelled documents that aren't held out, the same share for each language.

    They are those of the least hash of key and text, so the sample is the same whatever
    the partitions. Rows without label or letters are left out; without any labelled
    row the model has no language.
    """
    known = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id"))).withColumn("h", F.xxhash64("id"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    if not counts:
        return Model([], *[np.zeros((0, 0))] * 2, np.zeros(0), np.zeros((0, 0)))
    quota = max(1, most // len(counts))
    share = F.create_map(*[F.lit(v) for k, n in sorted(counts.items()) for v in (k, min(1.0, 1.5 * quota / n + 20 / n))])
    some = known.where(F.pmod("h", F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id", "text"))  # a bound, where many rows have one id
    some = some.withColumn("rank", rank).where(F.col("rank") <= quota).select("lang", "text")

    def vector(t: str) -> bytes | None:
        x = features(t)
        return None if x is None else x.astype(np.float16).tobytes()

    made = with_made(some, "text", "x", T.BinaryType(), lambda: vector)
    rows: list[Row] = made.select("lang", "x").where("x IS NOT NULL").collect()
    rows.sort(key=lambda r: (r["lang"], r["x"]))
    labels = sorted({r["lang"] for r in rows})
    if not labels:
        return Model([], *[np.zeros((0, 0))] * 2, np.zeros(0), np.zeros((0, 0)))
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
    return fit(x, np.array([labels.index(r["lang"]) for r in rows]), labels)


def predictor(model: Model) -> Callable[[str | None], tuple]:
    return model.predict


def identify(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """Add a struct: lang, score (0 to 1), ambiguous. Null texts and those without a letter are ``und`` with score 0.

    The whole text counts; every row and column stays.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = T.StructType.fromDDL("lang string, score double, ambiguous boolean")

    def make() -> Callable[[str | None], dict]:
        predict = predictor(shared.value)
        return lambda t: dict(zip(("lang", "score", "ambiguous"), predict(t), strict=True))

    return with_made(docs, text, into, kind, make)
