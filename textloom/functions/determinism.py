"""Seeded choices in place of random ones: the same input gives the same output on any cluster."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(*parts: Column | str) -> Column:
    """The first 32 bits of md5 over the parts, joined by ``|``; nulls are left out."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols).cast("binary")), 1, 8), 16, 10).cast("long")


def uniform(*parts: Column | str) -> Column:
    return number(*parts) / F.lit(4294967296.0)


def pick(pool: Column, *parts: Column | str) -> Column:
    """One element of a non-empty array, null of an empty one."""
    return F.when(F.size(pool) > 0, F.element_at(pool, (number(*parts) % F.size(pool) + 1).cast("int")))


def letter(n: Column) -> Column:
    return F.char(65 + n % 26)


def key6(*parts: Column | str) -> Column:
    """Two letters, a digit, two letters, a digit."""
    h = F.md5(F.concat_ws("|", *[F.col(p) if isinstance(p, str) else p for p in parts]).cast("binary"))
    digit = lambda i: F.conv(F.substring(h, i, 4), 16, 10).cast("long")
    parts6 = [letter(digit(1)), letter(digit(5)), (digit(9) % 10).cast("string"), letter(digit(13)), letter(digit(17)), (digit(21) % 10).cast("string")]
    return F.concat(*parts6)


def key8(*parts: Column | str) -> Column:
    """Three letters, a digit, three letters, a digit: names of files."""
    h = F.md5(F.concat_ws("|", *[F.col(p) if isinstance(p, str) else p for p in parts]).cast("binary"))
    digit = lambda i: F.conv(F.substring(h, i, 4), 16, 10).cast("long")
    return F.concat(*[(digit(4 * i + 1) % 10).cast("string") if i in (3, 7) else letter(digit(4 * i + 1)) for i in range(8)])
