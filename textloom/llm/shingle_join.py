"""Near-duplicates by the Jaccard similarity of shingle sets: keys, fingerprints, then the sets themselves.

Any two sets as similar as asked share a key. Within each key wide SimHash fingerprints
are compared tile by tile, with a radius of so many deviations that hardly any similar
pair lies outside it; what is linked so are candidates. A link counts only if the sets
of shingles, compared exactly, are as similar.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import ROWS, dealt, durable, in_batches, unused
from textloom.llm.components import components
from textloom.llm.tiles import WIDE, keyed_links, majority, radius_of

SLICE = 65_536
#: Levels (sizes from 2^level) below this have each shingle as a part of its own; others so many parts for each size.
FINE, LOAD = 5, 0.85
#: Sets of a candidate component that one task gathers; components with more are dealt out as pairs of parts.
PART = 1024
#: Candidates that are sent to all tasks to fetch their texts, of some 100 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Keys and texts that a task sorts, about.
KEYS_A_TASK, TEXTS_A_TASK = 500_000, 4096


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """The distinct 64-bit hashes of the word shingles, sorted; no words, no hashes.

    A-Z are lower-cased, words are split at ASCII white space; a text of fewer words is one shingle.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(parts))
    count = len(parts) - k + 1
    hashed, out = xxhash.xxh64_intdigest, []
    for at in range(0, count, SLICE):
        to = min(at + SLICE, count)
        out.append(np.array([hashed(joined[s:e], 42) for s, e in zip(starts[at:to].tolist(), ends[at + k - 1 : to + k - 1].tolist(), strict=True)], np.uint64))
    return np.unique(np.concatenate(out))


def similar(shared: np.ndarray, a: int, b: np.ndarray, least: Fraction) -> np.ndarray:
    """Whether sets of a and b elements that share so many have this Jaccard similarity."""
    p, q = least.numerator, least.denominator
    return shared * (p + q) >= p * (a + b)


def _mixed(h: np.ndarray, seed: int) -> np.ndarray:
    h = (h ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def set_keys(h: np.ndarray, least: Fraction, fine: frozenset[int] = frozenset()) -> tuple[np.ndarray, int]:
    """Keys of which any two sets as similar as ``least`` share one, and a bit for each level where this isn't certain.

    The hashes are cut by value into parts, and each part that isn't empty is a token.
    Sets of n and at most m elements differ in d = (n + m)(1 - t)/(1 + t) elements at
    most, so at most d tokens of the one are missing in the other; in an order common to
    all, the first token of both is therefore among the first d + 1 of each. Tokens of
    many shingles come first, as few texts share them. The larger set's level tells the
    parts; a set has the keys of its own level and of those its larger partners can have.
    A set with no more than d tokens can't be certain to share one: its level must be in
    ``fine``, where each shingle is a token.
    """
    n = len(h)
    if not n:
        return np.zeros(0, np.int64), 0
    p, q = least.numerator, least.denominator
    top, out, failed = n * q // p, [], 0
    for level in range(n.bit_length() - 1, top.bit_length()):
        most = min(top, (2 << level) - 1)
        d = (n + most) * (q - p) // (q + p)
        if level < FINE or level in fine:
            tokens = h[: d + 1]
        else:
            part = ((h >> np.uint64(32)) % np.uint64(int(LOAD * (1 << level)))).astype(np.int64)
            order = np.argsort(part, kind="stable")
            part, sorted_ = part[order], h[order]
            starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            sizes, sums = np.diff(np.append(starts, n)), np.add.reduceat(sorted_, starts)
            if len(starts) <= d:
                failed |= 1 << level
            first = np.lexsort((starts, -sizes))[: d + 1] if len(starts) > d else slice(None)
            tokens = _mixed(sums[first], 1) + part[starts][first].astype(np.uint64)
        out.append(_mixed(tokens, level + 2))
    return np.concatenate(out).view(np.int64), failed


def _sets(words: int, least: Fraction, fine: frozenset[int], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                rows = batch.slice(start, ROWS)
                number, prints, keys, failed = [], [], [], []
                for text in rows.column(1).to_pylist():
                    h = shingle_set(text, words)
                    number.append(xxhash.xxh64_intdigest(h.tobytes(), 7) - (1 << 63))
                    prints.append(majority(h, bits).tobytes())
                    k, f = set_keys(h, least, fine)
                    keys.append(k)
                    failed.append(f)
                offsets = pa.array(np.cumsum([0, *map(len, keys)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys), pa.int64()))
                columns = [rows.column(0), pa.array(number, pa.int64()), pa.array(prints, pa.binary()), lists, pa.array(failed, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "number", "fingerprint", "keys", "failed"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (key, number) of keys that several sets have, each once; rows come sorted by key and number."""
    last = None  # the last row, and whether it is out
    for batch in batches:
        if not batch.num_rows:
            continue
        key, number = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        out_before = True
        if last is not None:
            key, number = np.concatenate(([last[0]], key)), np.concatenate(([last[1]], number))
            out_before = last[2]
        other = np.concatenate(([True], (key[1:] != key[:-1]) | (number[1:] != number[:-1])))
        first_out = out_before and last is not None
        key, number = key[other], number[other]
        with_next = np.append(key[1:] == key[:-1], False)
        with_last = np.concatenate(([first_out], key[1:] == key[:-1]))
        several = with_next | with_last
        last = (key[-1], number[-1], bool(several[-1]))
        if first_out:
            several = several.copy()
            several[0] = False  # it went out before
        if several.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[several]), pa.array(number[several])], ["key", "number"])


def linked(sets: list[np.ndarray], least: Fraction) -> list[tuple[int, int]]:
    """Pairs that connect all sets as similar as ``least``, as few as connect them; no set may be empty.

    Each set is counted against those that no link has reached yet.
    """
    sizes = np.array([len(s) for s in sets])
    code = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(sizes)[:-1])
    mark = np.zeros(1 + max(int(c.max()) for c in code), np.int32)
    left, out = np.arange(len(sets)), []
    while len(left) > 1:
        todo, left, flat = [int(left[0])], left[1:], None
        while todo and len(left):
            i = todo.pop()
            if flat is None:
                flat = np.concatenate([code[j] for j in left.tolist()])
                starts = np.concatenate(([0], np.cumsum(sizes[left])[:-1]))
            mark[code[i]] = 1
            near = similar(np.add.reduceat(mark[flat], starts), sizes[i], sizes[left], least)
            mark[code[i]] = 0
            if near.any():
                found = left[near].tolist()
                out += [(i, j) for j in found]
                todo += found
                left, flat = left[~near], None
    return out


def _verified(words: int, least: Fraction):
    """Compare the texts of each run of equal groups; rows (group, number, text) come sorted by group."""

    def edges(number: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs = linked(sets, least) if len(sets) > 1 else []
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array([number[i] for i, _ in pairs], pa.int64()), pa.array([number[j] for _, j in pairs], pa.int64())], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, number, sets = None, [], []
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                rows = batch.slice(start, ROWS)
                for g, n, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    if g != group:
                        yield from edges(number, sets)
                        group, number, sets = g, [], []
                    number.append(n)
                    sets.append(shingle_set(text, words))
        yield from edges(number, sets)
        del number, sets
        unused()

    return run


def _fetched(docs: DataFrame, wanted: DataFrame, words: int, least: Fraction) -> DataFrame:
    """The links (u, v) within groups of ``wanted`` (chosen_id, number, groups), of texts fetched by id."""
    n, copies = wanted.agg(F.count("*"), F.sum(F.size("groups"))).first()
    texts = docs.select("id", "text").join(F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted, F.col("id").eqNullSafe(F.col("chosen_id")))
    gathered = dealt(texts.select(F.explode("groups").alias("group"), "number", "text"), "group", copies or 0, TEXTS_A_TASK).sortWithinPartitions("group")
    return in_batches(gathered, _verified(words, least), "u bigint, v bigint")


def verified_links(docs: DataFrame, chosen: DataFrame, words: int, least: Fraction) -> DataFrame:
    """Links (u, v) that connect all sets as similar as ``least`` within each candidate component of ``chosen`` (chosen_id, number, root).

    A component of over PART sets is dealt into parts, each with the component's least
    set, which connects most of a group of near copies. What isn't in the largest group
    found so is then compared with all of the component, part by part; so the cost grows
    with the component, times the parts of what stands apart.
    """
    whole, part = F.array("root"), lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "number"), n).cast("int")
    large = chosen.groupBy("root").agg(F.count("*").alias("n"), F.min("number").alias("pivot")).where(F.col("n") > PART)
    large = durable(large.select(F.col("root").alias("large"), "pivot", F.ceil(F.col("n") / PART).cast("int").alias("parts")))
    if not large.limit(1).count():
        return _fetched(docs, chosen.withColumn("groups", whole), words, least)
    group = lambda *c: F.xxhash64("root", *c)
    each = lambda n, make: F.transform(F.sequence(F.lit(0), n - 1), make)
    split = chosen.join(large, F.col("root") == F.col("large"), "left")
    own = F.when(F.col("number") == F.col("pivot"), each(F.col("parts"), lambda o: group(o))).otherwise(F.array(group(part(F.col("parts"), "own"))))
    first = durable(_fetched(docs, split.withColumn("groups", F.when(F.col("parts").isNull(), whole).otherwise(own)), words, least))

    reached = components(first).withColumnRenamed("root", "sub")
    inner = split.where("parts IS NOT NULL").join(reached, F.col("number") == F.col("node"), "left").withColumn("sub", F.coalesce("sub", "number"))
    inner = durable(inner.select("chosen_id", "number", "root", "parts", "sub"))
    sizes = inner.groupBy("root", "sub").agg(F.count("*").alias("n"))
    main = sizes.groupBy(F.col("root").alias("of")).agg(F.max(F.struct("n", "sub")).alias("main"), F.sum("n").alias("n"))
    main = durable(main.where(F.col("n") > F.col("main.n")).select("of", F.col("main.sub").alias("main"), F.ceil((F.col("n") - F.col("main.n")) / PART).cast("int").alias("apart")))
    rest = inner.join(main, F.col("root") == F.col("of"))
    met = each(F.col("apart"), lambda o: group(F.lit("met"), o, part(F.col("parts"), "own")))
    meets = each(F.col("parts"), lambda o: group(F.lit("met"), part(F.col("apart"), "apart"), o))
    groups = F.when(F.col("sub") == F.col("main"), met).otherwise(F.array_distinct(F.concat(met, meets)))
    return first.union(_fetched(docs, durable(rest.select("chosen_id", "number", groups.alias("groups"))), words, least))


def near_sets(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, component_id) of every row of ``docs`` (id, text): the least id reachable by links of this similarity or more.

    Texts with one shingle set are linked, those without words too. Sets and shingles are
    told apart by hashes of 64 bits. Every pair as similar shares a key; that its
    fingerprints lie farther apart than the radius has a probability under one in a
    million, a thousandth for sets of five shingles or fewer.
    """
    least = Fraction(similarity).limit_denominator(10_000)
    kind = f"id {docs.schema['id'].dataType.simpleString()}, number bigint, fingerprint binary, keys array<bigint>, failed bigint"
    fine: frozenset[int] = frozenset()
    while True:
        found = durable(in_batches(docs.select("id", "text"), _sets(words, least, fine, WIDE), kind))
        failed, n = found.agg(F.bit_or("failed"), F.sum(F.size("keys"))).first()
        if not failed:
            break
        fine |= {i for i in range(64) if failed >> i & 1}
    named = durable(found.groupBy("number").agg(F.min("id").alias("least"), F.first("fingerprint").alias("fingerprint")))
    keyed = dealt(found.select(F.explode("keys").alias("key"), "number"), "key", n or 0, KEYS_A_TASK).sortWithinPartitions("key", "number")
    keyed = durable(in_batches(keyed, _shared, "key bigint, number bigint"))
    printed = durable(keyed.join(named.select("number", "fingerprint"), "number").select("key", "fingerprint"))
    likely = components(keyed_links(printed, radius_of(similarity), WIDE))
    # sets of one fingerprint are candidates too
    equal = named.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1").select(F.col("fingerprint").alias("node"), F.col("fingerprint").alias("root"))
    likely = likely.union(equal.join(likely, "node", "left_anti"))
    chosen = named.join(likely, F.col("fingerprint") == F.col("node")).select(F.col("least").alias("chosen_id"), "number", F.xxhash64("root").alias("root"))
    roots = components(verified_links(docs, durable(chosen), words, least))
    grouped = named.join(roots, named["number"] == roots["node"], "left").select("number", "least", F.coalesce("root", "number").alias("root"))
    best = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    return found.select("id", "number").join(grouped.join(best, "root").select("number", "component_id"), "number").select("id", "component_id")
