"""Tiled exact comparison of fingerprints by numpy's exclusive-or and bit counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import dealt, durable, in_batches

#: Fingerprints of a tile: what one comparison holds in memory is its square in bytes, times eight.
TILE = 512
#: Fingerprints that one task gathers of a key; keys with more are dealt out as pairs of parts.
PART = 4096
#: Rows of a task that compares, about.
ROWS_A_TASK = 250_000
#: Bits of a wide fingerprint; standard deviations of its distance that are allowed above the wanted one.
WIDE, SLACK = 256, 5.0


def spread(h: np.ndarray, lanes: int) -> np.ndarray:
    """Each hash as so many words: itself if one, else mixed anew for each."""
    if lanes == 1:
        return h[:, None]
    out = h[:, None] ^ (np.arange(1, lanes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
    out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def ones_of(h: np.ndarray, bits: int) -> np.ndarray:
    """In how many of the hashes each bit is set."""
    lanes = np.ascontiguousarray(spread(h, bits // 64))
    return np.unpackbits(lanes.view(np.uint8).reshape(len(h), -1), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def majority(h: np.ndarray, bits: int = WIDE, most: int = 16_384) -> np.ndarray:
    """The fingerprint of a set of hashes, as words of 64 bits: the bits set in over half of them; no hashes, no bits."""
    ones = sum((ones_of(h[i : i + most], bits) for i in range(0, len(h), most)), np.zeros(bits, np.int64))
    return np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")


def radius_of(similarity: float, bits: int = WIDE, slack: float = SLACK) -> int:
    """The bits in which fingerprints of shingle sets of this Jaccard similarity differ, and ``slack`` deviations more.

    Sets of one size with similarity s have the cosine 2s/(1+s), and each bit differs
    with the share that the angle has of a half turn.
    """
    p = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return round(bits * p + slack * np.sqrt(bits * p * (1 - p)))


def _spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric table of links."""
    left = linked.any(axis=1)
    out = []
    while left.any():
        front = np.flatnonzero(left)[:1]
        left[front] = False
        while front.size:
            reached = linked[front] & left
            new = np.flatnonzero(reached.any(axis=0))
            out += zip(front[reached[:, new].argmax(axis=0)].tolist(), new.tolist(), strict=True)
            left[new] = False
            front = new
    return out


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of each of x and each of y; both have a row of words for each fingerprint."""
    out = np.zeros((len(x), len(y)), np.uint16)
    for lane in range(x.shape[1]):
        out += np.bitwise_count(x[:, lane, None] ^ y[None, :, lane])
    return out


def links(values: np.ndarray, radius: int) -> np.ndarray:
    """Pairs of rows that connect all fingerprints at most ``radius`` bits apart: as few as connect them.

    Fingerprints are sorted by their bit counts and compared tile by tile; tile pairs
    whose bit counts differ beyond the radius are skipped. Of the links found, those
    count that join two sets which aren't joined yet.
    """
    counts = np.bitwise_count(values).sum(axis=1, dtype=np.int32)
    order = np.argsort(counts, kind="stable")
    values, counts = values[order], counts[order]
    root = np.arange(len(values))
    out: list[tuple[int, int]] = []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(0, len(values), TILE):
        x = values[i : i + TILE]
        for j in range(i, len(values), TILE):
            if counts[j] - counts[min(i + TILE, len(values)) - 1] > radius:
                break
            roots = np.concatenate((root[i : i + TILE], root[j : j + TILE]))
            if i != j and (roots == roots[0]).all():
                continue  # all joined already
            y = values[j : j + TILE]
            near = distances(x, y) <= radius
            near &= root[i : i + TILE, None] != root[None, j : j + TILE]
            p, q = np.nonzero(np.triu(near, 1) if i == j else near)
            if len(p) > 2 * (len(x) + len(y)):
                n = len(x)
                square = near | near.T if i == j else np.zeros((n + len(y),) * 2, bool)
                if i != j:
                    square[:n, n:], square[n:, :n] = near, near.T
                kept = np.array(_spanning(square))
                at = np.arange(i, i + n) if i == j else np.concatenate((np.arange(i, i + n), np.arange(j, j + len(y))))
                pairs = at[kept]
            else:
                pairs = np.stack((p + i, q + j), axis=1)
            for a, b in pairs.tolist():
                u, v = top(a), top(b)
                if u != v:
                    root[max(u, v)] = min(u, v)
                    out.append((a, b))
            if len(pairs):
                while (root[root] != root).any():
                    root = root[root]
    return order[np.array(out, np.int64).reshape(-1, 2)]


def _words(column: pa.Array) -> np.ndarray:
    """A column of longs or of binaries of one length, as rows of words."""
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False).view(np.uint64)[:, None]
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _column(values: np.ndarray) -> pa.Array:
    if values.shape[1] == 1:
        return pa.array(values[:, 0].view(np.int64), pa.int64())
    return pa.array([v.tobytes() for v in values], pa.binary())


def _compare(radius: int):
    """Compare the fingerprints of each run of equal groups; rows come sorted by group."""

    def within(group: np.ndarray, value: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        sizes = np.diff(np.append(starts, len(group)))
        few = np.repeat(sizes <= 16, sizes)
        for d in range(1, 16):  # small groups all at once: each row against the d-th after it
            if len(group) <= d or not (sizes[sizes <= 16] > d).any():
                break
            at = np.flatnonzero(few[:-d] & (group[d:] == group[:-d]))
            at = at[np.bitwise_count(value[at] ^ value[at + d]).sum(axis=1, dtype=np.int32) <= radius]
            yield value[at], value[at + d]
        for s, n in zip(starts[sizes > 16].tolist(), sizes[sizes > 16].tolist(), strict=True):
            pairs = links(value[s : s + n], radius) + s
            yield value[pairs[:, 0]], value[pairs[:, 1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = value = None

        def edges(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            for p, q in found:
                if len(p):
                    yield pa.RecordBatch.from_arrays([_column(p), _column(q)], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            g, v = batch.column(0).to_numpy(zero_copy_only=False), _words(batch.column(1))
            group = g if group is None else np.concatenate((group, g))
            value = v if value is None else np.concatenate((value, v))
            last = int(np.searchsorted(group, group[-1]))
            if last:
                yield from edges(within(group[:last], value[:last]))
                group, value = group[last:], value[last:]
        if group is not None and len(group):
            yield from edges(within(group, value))

    return run


def keyed_links(keyed: DataFrame, radius: int, bits: int = 64) -> DataFrame:
    """Pairs (u, v) that connect the fingerprints of each key within the radius, of rows (key, fingerprint).

    Fingerprints are longs if of 64 bits, else binaries. A key with many is dealt out by
    hash into parts; each pair of parts is compared in a group of its own.
    """
    value = F.col("fingerprint")
    large = durable(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > PART))
    if large.limit(1).count():
        split = keyed.join(large, "key", "left")
        parts = F.ceil(F.col("n") / PART).cast("int")
        part = F.pmod(F.xxhash64(F.lit("part"), value), parts).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), parts - 1), lambda o: F.xxhash64("key", F.least(o, part), F.greatest(o, part)))
        keyed = split.select(F.explode(F.when(F.col("n").isNull(), F.array("key")).otherwise(pairs)).alias("key"), value)
    ready = dealt(keyed.select("key", "fingerprint"), "key", keyed.count(), ROWS_A_TASK).sortWithinPartitions("key")
    kind = "bigint" if bits == 64 else "binary"
    return in_batches(ready, _compare(radius), f"u {kind}, v {kind}")
