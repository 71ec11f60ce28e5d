"""The most similar vectors of a block of queries: matrix products over batches of items, then exact values."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Queries and items whose products are held at a time, few enough to stay in a core's cache; pairs that are handed on at a time, and that are worked out exactly at a time.
ROWS, COLUMNS, PAIRS, EXACT = 256, 1024, 1 << 18, 1 << 12
#: Groups of a tile's items at most; the greatest products of the groups give a query's first bound.
GROUPS = 128
#: Items that are gathered before a search, so that copies among them fall together; items of a task's first search, whose bounds the next ones have.
GATHERED, BEGIN = 1 << 16, 1 << 12
#: What similarities that aren't numbers count in the order: NaN comes first, as in Spark, and null last.
FIRST, LAST = 4.0, -4.0


def vectors(column: pa.Array | pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) for each length of vectors; null vectors and those that hold a null are in none."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    values = flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
    whole = sizes > 0
    if flat.null_count:
        nulls = np.flatnonzero(flat.is_null().to_numpy(zero_copy_only=False))
        whole[np.searchsorted(starts + np.maximum(sizes, 0), nulls, side="right")] = False
    out = []
    for size in np.unique(sizes[whole]).tolist():
        at = np.flatnonzero(whole & (sizes == size))
        out.append((at, values[starts[at][:, None] + np.arange(size)]))
    return out


def rounded(x: np.ndarray) -> np.ndarray:
    """Six decimals, halves away from zero, without a negative zero."""
    y = x * 1e6
    return np.trunc(y + np.copysign(0.5, y)) / 1e6 + 0.0


class Block:
    """Queries of one length with what the products need: exact and short unit vectors, and norms."""

    def __init__(self, at: np.ndarray, matrix: np.ndarray) -> None:
        with np.errstate(all="ignore"):
            self.at, self.exact, self.norm = at, matrix, np.sqrt((matrix * matrix).sum(axis=1))
            self.odd, self.zero = ~np.isfinite(self.norm), self.norm == 0
            self.plain = ~(self.odd | self.zero)
            # of vectors whose norm is no usual number the short form is no number either
            self.short = (matrix / np.where(self.plain, self.norm, np.nan)[:, None]).astype(np.float32)


def exact(queries: Block, items: Block, q: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Orders of the similarities of pairs of rows: the rounded value, FIRST for NaN, LAST for null."""
    out = np.empty(len(q))
    with np.errstate(all="ignore"):
        for s in range(0, len(q), EXACT):
            a, b = q[s : s + EXACT], i[s : s + EXACT]
            length = queries.norm[a] * items.norm[b]
            value = np.einsum("ij,ij->i", queries.exact[a], items.exact[b]) / length
            value = np.where(np.isnan(value), FIRST, rounded(value))
            out[s : s + EXACT] = np.where((length > 0) | np.isnan(length), value, LAST)
    return out


def crossed(q: np.ndarray, i: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of two lists, some at a time."""
    step = max(1, PAIRS // max(1, len(i)))
    for s in range(0, len(q) if len(i) else 0, step):
        a = q[s : s + step]
        yield np.repeat(a, len(i)), np.tile(i, len(a))


def marked(hit: np.ndarray) -> np.ndarray:
    """Places of the few that are true, eight looked at at a time; their number is a multiple of eight."""
    eights = np.flatnonzero(hit.view(np.uint64) != 0)  # of what is no boolean it is slow
    one, bit = np.nonzero(hit.reshape(-1, 8)[eights])
    return eights[one] * 8 + bit


def likely(queries: Block, items: Block, least: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of plain vectors that can be among the k best of a query, whose k-th so far is in ``least``.

    The greatest products of k groups of items are those of k items, so the least of
    them is a bound for the k-th best, as ``least`` is.
    """
    slack = (queries.exact.shape[1] + 8) * 2.0**-23 + 2e-6  # of short products, and of rounding
    rows, columns = np.flatnonzero(queries.plain), np.flatnonzero(items.plain)
    right = items.short[columns]
    products, hits = np.empty(ROWS * COLUMNS, np.float32), np.zeros(ROWS * COLUMNS, bool)
    found, pairs = [], 0
    for s in range(0, len(rows), ROWS):
        at = rows[s : s + ROWS]
        left, low = np.ascontiguousarray(queries.short[at].T), np.maximum(least[at] - slack, -2).astype(np.float32)
        top = np.full((k, len(at)), -np.inf, np.float32)
        for c in range(0, len(right), COLUMNS):
            tile = right[c : c + COLUMNS]
            size = len(tile) * len(at)
            near = np.matmul(tile, left, out=products[:size].reshape(len(tile), len(at)))
            hit = hits[:size].reshape(near.shape)
            np.greater_equal(near, low, out=hit)
            if (n := np.count_nonzero(hit)) > 2 * k * len(at):
                groups = min(len(tile), max(GROUPS, 4 * k))
                width = len(tile) // groups
                most = near[: groups * width].reshape(groups, width, len(at)).max(axis=1)
                top = np.partition(np.concatenate((top, most)), groups, axis=0)[groups:]
                low = np.maximum(low, top.min(axis=0) - np.float32(2 * slack))
                np.greater_equal(near, low, out=hit)
                n = np.count_nonzero(hit)
            if not n:
                continue
            whole = -(-size // 8) * 8
            hits[size:whole] = False
            i, q = np.divmod(marked(hits[:whole]), len(at))
            found.append((at[q], columns[c + i]))
            pairs += n
        if pairs >= PAIRS or s + ROWS >= len(rows):
            if found:
                yield np.concatenate([q for q, _ in found]), np.concatenate([i for _, i in found])
            found, pairs = [], 0


def alike(matrix: np.ndarray) -> np.ndarray:
    """For each row the first row with the same bits."""
    bits, digest = np.ascontiguousarray(matrix).view(np.uint64), np.empty(len(matrix), np.uint64)
    odd = np.random.default_rng(0).integers(1 << 63, size=bits.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for s in range(0, len(bits), EXACT):
        mixed = (bits[s : s + EXACT] ^ (bits[s : s + EXACT] >> np.uint64(29))) * odd  # doubles of short floats end in zeros
        digest[s : s + EXACT] = (mixed ^ (mixed >> np.uint64(32))).sum(axis=1)
    _, first, place = np.unique(digest, return_index=True, return_inverse=True)
    first = first[place]
    same = first == np.arange(len(bits))
    rest = np.flatnonzero(~same)
    same[rest] = (bits[rest] == bits[first[rest]]).all(axis=1)
    return np.where(same, first, np.arange(len(bits)))


def least_copies(batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
    """Rows without those of which k others with the same vector have lesser items: they can't be among the k best."""
    keep = np.ones(batch.num_rows, bool)
    for at, matrix in vectors(batch.column(1)):
        first = alike(matrix)
        many = np.flatnonzero(np.bincount(first, minlength=len(first))[first] > k)
        if len(many):
            keys = pa.table({"v": first[many], "i": batch.column(0).take(pa.array(at[many]))})
            order = many[pc.sort_indices(keys, sort_keys=[("v", "ascending"), ("i", "ascending")], null_placement="at_start").to_numpy()]
            keep[at[order[np.arange(len(order)) - np.searchsorted(first[order], first[order]) >= k]]] = False
    return batch if keep.all() else batch.filter(pa.array(keep))


def gathered(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Batches of some GATHERED rows in the end, without what ``least_copies`` leaves out, and the first ones small."""
    held: list[pa.RecordBatch] = []
    rows = seen = 0
    at_end = object()
    while True:
        batch = next(batches, at_end)
        if batch is not at_end:
            held.append(batch)
            rows += batch.num_rows
            if rows < GATHERED:
                continue
        if rows:
            one = least_copies(pa.concat_batches(held), k)
            held, rows = [one], one.num_rows
        if batch is not at_end and rows <= GATHERED // 2:
            continue
        s = 0
        while s < rows:
            part = one.slice(s, max(BEGIN, seen))
            yield part
            s, seen = s + part.num_rows, seen + part.num_rows
        held, rows = [], 0
        if batch is at_end:
            return


def best(q: np.ndarray, order: np.ndarray, item: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The k first rows of each query, by query: the greatest order, then the least item."""
    keys = pa.table({"q": q, "o": -order, "i": item})
    at = pc.sort_indices(keys, sort_keys=[("q", "ascending"), ("o", "ascending"), ("i", "ascending")], null_placement="at_start").to_numpy()
    sorted_ = q[at]
    place = np.arange(len(at)) - np.searchsorted(sorted_, sorted_)
    at = at[place < k]
    return q[at], order[at], item.take(pa.array(at))


def nearest(count: int, queries: Callable[[], tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]], k: int):
    """For mapInArrow over (item, vector): rows (query, item, similarity), each query's k best of a task's items.

    Queries with the same vector are searched once, and of items with the same vector
    the k least only, as ties go to the lesser item.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not count:
            return
        names, parts = queries()
        one = np.arange(len(names))  # for each query the one that is searched in its place
        for at, m in parts:
            one[at] = at[alike(m)]
        asked, place = np.unique(one, return_inverse=True)
        members, starts = np.argsort(place, kind="stable"), np.searchsorted(np.sort(place), np.arange(len(asked) + 1))
        total = len(asked)
        blocks = {m.shape[1]: Block(place[at[first]], m[first]) for at, m in parts for first in [one[at] == at]}
        state: tuple[np.ndarray, np.ndarray, pa.Array] | None = None
        least = np.full(total, -np.inf)  # the k-th best of each query that has k

        def candidates(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            """(query, order, row) of all pairs of a batch that can be among the best."""
            told = np.zeros(batch.num_rows, bool)
            for at, matrix in vectors(batch.column(1)):
                if (block := blocks.get(matrix.shape[1])) is None:
                    continue
                items, told[at] = Block(at, matrix), True
                rows, columns = np.arange(len(block.at)), np.arange(len(at))
                for pairs in (likely(block, items, least[block.at], k), crossed(rows[block.odd], columns), crossed(rows[~block.odd], columns[items.odd])):
                    for q, i in pairs:
                        yield block.at[q], exact(block, items, q, i), at[i]
                yield from null_pairs(block.at[block.zero], at[~items.odd])
                yield from null_pairs(block.at[block.plain], at[items.zero])
                yield from null_pairs(np.setdiff1d(np.arange(total), block.at), at)
            yield from null_pairs(np.arange(total), np.flatnonzero(~told))

        def null_pairs(q: np.ndarray, i: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            """Pairs without a similarity; they count for queries that lack better ones only."""
            for a, b in crossed(q[least[q] <= LAST], i):
                yield a, np.full(len(a), LAST), b

        for batch in gathered(batches, k):
            for q, order, row in candidates(batch):
                keep = order >= least[q]
                if not keep.any():
                    continue
                q, order, item = q[keep], order[keep], batch.column(0).take(pa.array(row[keep]))
                if state is not None:
                    met = np.zeros(total, bool)
                    met[q] = True
                    old = met[state[0]]
                    rest = (state[0][~old], state[1][~old], state[2].filter(pa.array(~old)))
                    q, order, item = np.concatenate((q, state[0][old])), np.concatenate((order, state[1][old])), pa.concat_arrays([item, state[2].filter(pa.array(old))])
                q, order, item = best(q, order, item, k)
                last = np.flatnonzero(np.append(q[1:] != q[:-1], True))
                full = np.diff(np.append(-1, last)) == k
                least[q[last[full]]] = order[last[full]]
                state = (q, order, item) if state is None else (np.concatenate((rest[0], q)), np.concatenate((rest[1], order)), pa.concat_arrays([rest[2], item]))
        if state is not None:
            q, order, item = state
            row = np.repeat(np.arange(len(q)), np.diff(starts)[q])  # k rows a query, as every query gets its own
            name = members[starts[q[row]] + np.arange(len(row)) - np.searchsorted(row, row)]
            for s in range(0, len(row), 1 << 16):
                part = row[s : s + (1 << 16)]
                o = order[part]
                value = pa.array(np.where(o == FIRST, np.nan, o), pa.float64(), mask=o == LAST, from_pandas=False)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(name[s : s + (1 << 16)])), item.take(pa.array(part)), value], ["query", "item", "similarity"])

    return run
