"""Mixing sources to target weights by Pfair scheduling of blocks.

Every source's documents are dealt to blocks of equal length, in the order of a hash. An
ideal mix gives all sources at every moment what is due to them: shares of each slot in
proportion to the weights of those that have something left. A source's block is released
in the slot in which the ideal mix starts it, and its deadline is the end of the slot in
which the ideal mix ends it; of the released blocks the one with the earliest deadline
takes the next slot. The ideal mix is a schedule in fractions that keeps all windows, so
there is one in whole blocks, and the earliest deadline first finds it: at every slot each
source is less than one block from its share. Weights count exactly, as the fractions
that they are.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Sequence
from fractions import Fraction
from itertools import accumulate
from math import lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textloom.llm.common import dealt, fresh, partitions

#: Documents of a block at least; blocks at most, for which blocks get longer; rows of a ranking group; blocks of a row of slots.
BLOCK, MOST_BLOCKS, GROUP, SEGMENT = 64, 1 << 20, 4096, 256
MOST_SOURCES = 10_000


def whole(weights: Sequence[float]) -> list[int]:
    """Whole numbers in exactly the proportion of the weights."""
    exact = [Fraction(w) for w in weights]
    common = lcm(*(w.denominator for w in exact))
    return [int(w * common) for w in exact]


def schedule(blocks: Sequence[int], weights: Sequence[float]) -> list[list[int]]:
    """For each source the slots of its blocks, in order; weights are positive.

    When the ideal mix has given each source v times its weight, or all of a source that
    has less, it is at the sum of these: so a block's start and end are found at once,
    from the sources that have ended by then and the weights of the others.
    """
    part = whole(weights) if len(weights) else []
    ends = sorted((Fraction(n, w), n, w) for n, w in zip(blocks, part, strict=True) if n)
    at = [e[0] for e in ends]
    given = [0, *accumulate(e[1] for e in ends)]
    left = [sum(e[2] for e in ends)]
    for e in ends:
        left.append(left[-1] - e[2])

    def moment(k: int, w: int) -> tuple[int, int]:
        """When the ideal mix has given k blocks to a source of weight w, as a whole part and a rest of w."""
        gone = bisect_right(at, Fraction(k, w))
        whole_, rest = divmod(k * left[gone], w)
        return given[gone] + whole_, rest

    slots: list[list[int]] = [[] for _ in blocks]
    waiting = [(0, s, 0) for s, n in enumerate(blocks) if n]  # release, source, block
    ready: list[tuple[int, int, int]] = []
    for t in range(sum(blocks)):
        while waiting and waiting[0][0] <= t:
            _, s, i = heapq.heappop(waiting)
            whole_, rest = moment(i + 1, part[s])
            heapq.heappush(ready, (whole_ + (rest > 0), s, i))
        deadline, s, i = heapq.heappop(ready)
        if deadline <= t:
            raise AssertionError("a block has missed its deadline")
        slots[s].append(t)
        if i + 1 < blocks[s]:
            heapq.heappush(waiting, (moment(i + 1, part[s])[0], s, i + 1))
    return slots


def ranked(docs: DataFrame, key: str, source: str, counts: dict, rank_: str) -> DataFrame:
    """``docs`` with each row's place within its source, from 0, in the order of a hash of its key.

    The hash's top bits cut a source into groups of about GROUP rows, more bits if it has
    more rows; each group is sorted by itself, and the groups before it in the source give
    its first place. Null keys are told apart by a hash of the whole row.
    """
    order_, group_, named_ = (fresh([*docs.columns, rank_], c) for c in ("order", "group", "named"))
    whole_row = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if not isinstance(docs.schema[c].dataType, T.MapType)])
    order = F.when(F.col(f"`{key}`").isNull(), whole_row).otherwise(F.xxhash64(F.col(f"`{key}`").cast("string")))
    # never null, so the window's shuffle serves the join as well
    known = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))
    rows = docs.withColumn(order_, order).withColumn(named_, known(F.col(f"`{source}`")))
    spread = [("" if s is None else "=" + str(s), (n // GROUP).bit_length()) for s, n in counts.items() if n > GROUP]
    if spread:  # at most as many rows as sources
        bits_, of_ = fresh(rows.columns, "bits"), fresh(rows.columns, "of")
        large = docs.sparkSession.createDataFrame(spread, f"`{of_}` string, `{bits_}` int")
        rows = rows.join(F.broadcast(large), rows[named_] == large[of_], "left")
        # a shift with sign keeps the order of the hash
        group = F.when(F.col(bits_).isNull(), F.lit(0)).otherwise(F.call_function("shiftright", F.col(order_), 64 - F.col(bits_)))
        rows = rows.withColumn(group_, group.cast("long")).drop(bits_, of_)
    else:
        rows = rows.withColumn(group_, F.lit(0).cast("long"))
    sizes = rows.groupBy(F.col(named_).alias("s"), F.col(group_).alias("g")).agg(F.count("*").alias("n"))
    before = sizes.select("s", "g", (F.sum("n").over(Window.partitionBy("s").orderBy("g")) - F.col("n")).alias("before"))
    rows = dealt(rows, [named_, group_], sum(counts.values()), GROUP)
    own = Window.partitionBy(named_, group_).orderBy(order_, f"`{key}`")
    rows = rows.withColumn(rank_, F.row_number().over(own) - 1)
    joined = rows.join(before, (rows[named_] == before["s"]) & (rows[group_] == before["g"]))
    return joined.select(*[rows[f"`{c}`"] for c in docs.columns], (rows[rank_] + before["before"]).alias(rank_))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", weights: dict[str | None, float] | None = None, block: int | None = None, into: str = "mix") -> DataFrame:
    """Add a struct to every row: block (of its source), slot (of the block in the mix), position.

    Ordering by position gives the mix. Without ``weights`` a source's is the square root
    of its rows; sources that ``weights`` lacks are an error, as are weights that aren't
    positive. A block has BLOCK rows, or as many more as keep all sources under
    MOST_BLOCKS blocks together, as the driver schedules them one by one. No row is left
    out or repeated: when a source ends, the others go on at their relative weights. A
    null source is a source; null keys and repeated rows are placed like any others. A
    source's last block may be short, so positions can have gaps. No rows, no result.
    """
    if fresh(docs.columns, into) != into:
        raise ValueError(f"the column {into} exists")
    found = docs.groupBy(F.col(f"`{source}`").alias("s")).agg(F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"over {MOST_SOURCES} sources")
    counts = {r["s"]: r["n"] for r in sorted(found, key=lambda r: (r["s"] is not None, str(r["s"])))}
    wanted = {s: n**0.5 for s, n in counts.items()} if weights is None else {s: weights[s] for s in counts}
    if any(not w > 0 for w in wanted.values()):
        raise ValueError("weights must be positive")
    names = list(counts)
    size = block or max(BLOCK, -(-sum(counts.values()) // (MOST_BLOCKS - len(names))))
    blocks = [-(-counts[s] // size) for s in names]
    if sum(blocks) > MOST_BLOCKS:
        raise ValueError(f"over {MOST_BLOCKS} blocks; let them be longer")
    plan = schedule(blocks, [wanted[s] for s in names])
    kind = T.StructType([T.StructField("s", docs.schema[source].dataType), *T.StructType.fromDDL("segment bigint, slots array<bigint>").fields])
    cuts = [(s, i // SEGMENT, slots[i : i + SEGMENT]) for s, slots in zip(names, plan, strict=True) for i in range(0, len(slots), SEGMENT)]
    # a long for each of MOST_BLOCKS blocks at most, and a row for each source
    slots = F.broadcast(docs.sparkSession.createDataFrame(cuts, kind))

    rank_, block_ = fresh(docs.columns, "rank"), fresh(docs.columns, "block")
    rows = ranked(docs, key, source, counts, rank_).withColumn(block_, F.floor(F.col(rank_) / size))
    placed = rows.join(slots, rows[f"`{source}`"].eqNullSafe(slots["s"]) & (F.floor(F.col(block_) / SEGMENT) == slots["segment"]))
    slot = F.element_at(slots["slots"], (F.col(block_) % SEGMENT + 1).cast("int"))
    out = F.struct(F.col(block_).alias("block"), slot.alias("slot"), (slot * size + F.col(rank_) % size).alias("position"))
    return placed.select(*[rows[f"`{c}`"] for c in docs.columns], out.alias(into))


def in_order(docs: DataFrame, into: str = "mix", rows: int | None = None) -> DataFrame:
    """The mix in order over its partitions, which are cut by position; ``rows``, if told, bounds their size."""
    place = F.col(f"{into}.position")
    parts = [] if rows is None else [partitions(docs.sparkSession, rows, GROUP)]
    return docs.repartitionByRange(*parts, place).sortWithinPartitions(place)
