"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import sys
import tempfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores before it until no column has it in any case."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of this machine is set only where a local session names none, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or _own_folder())
    return sc.getCheckpointDir()


def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="checkpoints")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder, which outlives executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def released(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files (and, where it is set to, checkpoints) of data that nothing refers to any more.

    It does so only when the driver collects its garbage, which a driver with little to do may not do for long.
    """
    gc.collect()
    spark._jvm.System.gc()


#: Keys of rows to be left out that are broadcast: of 24 to 40 bytes each.
BROADCAST_KEYS = 200_000


def without(rows: DataFrame, gone: DataFrame, key: Sequence[Column], broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``rows`` without those whose key is in ``gone``, which has a column for each part of the key; nulls are equal.

    Rows stay where they are as long as ``gone`` is small; else both sides are dealt by the key.
    """
    names = [fresh([*rows.columns, *gone.columns], f"part{i}") for i in range(len(key))]
    out = gone.toDF(*[n + "_gone" for n in names])
    if gone.count() <= broadcast_keys:
        out = F.broadcast(out)
    same = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(n + "_gone")) for n in names])
    keyed = rows.withColumns(dict(zip(names, key, strict=True)))
    return keyed.join(out, same, "left_anti").drop(*names)


def dealt(rows: DataFrame, key: str | Sequence[str], count: int, each: int) -> DataFrame:
    """``rows`` dealt by ``key`` to as many partitions as make ``each`` rows a partition, within what the session sets."""
    return rows.repartition(partitions(rows.sparkSession, count, each), *([key] if isinstance(key, str) else key))


def partitions(spark: SparkSession, count: int, each: int) -> int:
    """Partitions of ``each`` rows: at least one for each core, at most the session's shuffle partitions."""
    cores = spark.sparkContext.defaultParallelism
    return min(max(cores, -(-count // each)), max(cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and no other character changed; null stays null."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # lower() has a fast path for ASCII; other texts need translate(), as lower() would change their letters too
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


#: Bytes of an Arrow batch, about: batches of long texts are held several times over, outside of the JVM's heap and in Python.
BATCH_BYTES = 4 << 20


def in_batches(df: DataFrame, run: Callable, kind: T.StructType | str) -> DataFrame:
    """mapInArrow with batches of BATCH_BYTES at most, to which the session's limit is lowered if it is higher."""
    conf, limit = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(limit).removesuffix("b")) > BATCH_BYTES:
        conf.set(limit, str(BATCH_BYTES))
    return df.mapInArrow(run, kind)


def unused() -> None:
    """Give memory that a task has used back, as its Python worker waits for other tasks."""
    gc.enable()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)


#: Rows of which values are in Python at a time; a batch of Arrow has many more.
ROWS = 256


def with_made(df: DataFrame, source: str, name: str, kind: T.DataType, make: Callable[[], Callable], keep: bool = True) -> DataFrame:
    """df with the column ``name`` put last, made of ``source`` in Arrow batches, and without ``source`` unless ``keep``.

    ``make`` is called once a task for the function of one value. The other columns go
    along as Arrow arrays. A column already named ``name`` in any case is an error.
    """

    def one() -> Callable:
        made = make()
        return lambda v: (made(v),)

    return with_several_made(df, source, [(name, kind)], one, keep)


def with_several_made(df: DataFrame, source: str, made: Sequence[tuple[str, T.DataType]], make: Callable[[], Callable], keep: bool = True) -> DataFrame:
    """As with_made, for several columns, of which the function gives a tuple."""
    for i, (name, _) in enumerate(made):
        if fresh([*df.columns, *(n for n, _ in made[:i])], name) != name:
            raise ValueError(f"the column {name} exists")
    at, to = df.columns.index(source), [to_arrow_type(kind) for _, kind in made]
    stay = [i for i in range(len(df.columns)) if keep or i != at]
    names = [n for n, _ in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        gc.disable()  # values make no cycles, and a search for them costs time; unused() ends this
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS):
                    rows = batch.slice(start, ROWS)
                    values = [one(v) for v in rows.column(at).to_pylist()]
                    new = [pa.array([v[k] for v in values], kind) for k, kind in enumerate(to)]
                    yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in stay), *new], [*(rows.schema.names[i] for i in stay), *names])
        finally:
            del one
            unused()

    return in_batches(df, run, T.StructType([*(df.schema.fields[i] for i in stay), *(T.StructField(n, kind) for n, kind in made)]))
