"""Dates in text: quarters, and shifts that keep the layout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: German month names, the long form first, with their number.
MONTHS = (
    ("Januar", "Jänner", "Jän", "Jan"), ("Februar", "Feber", "Feb"), ("März", "Mrz"), ("April", "Apr"), ("Mai",), ("Juni", "Jun"),
    ("Juli", "Jul"), ("August", "Aug"), ("September", "Sept", "Sep"), ("Oktober", "Okt"), ("November", "Nov"), ("Dezember", "Dez"),
)
MONTH_OF = {name.lower(): i + 1 for i, names in enumerate(MONTHS) for name in names}
ALPHA = "|".join(sorted((n for names in MONTHS for n in names), key=len, reverse=True))
DAY_FIRST = r"^\s*(\d{1,2})([./-]\s*)(\d{1,2})([./-]\s*)(\d{4}|\d{2})\s*(\.?)\s*$"
YEAR_FIRST = r"^\s*(\d{4})([./-]\s*)(\d{1,2})([./-]\s*)(\d{1,2})\s*(\.?)\s*$"
NAMED = rf"^\s*(\d{{1,2}})(\.?\s*)((?i:{ALPHA})\.?)(\s*)(\d{{4}}|\d{{2}})\s*(\.?)\s*$"
DAY_MONTH = r"^\s*(\d{1,2})([./-]\s*)(\d{1,2})(\.?)\s*$"
MONTH_YEAR = r"^\s*(\d{1,2})([./-]\s*)(\d{4})\s*(\.?)\s*$"
NAMED_YEAR = rf"^\s*((?i:{ALPHA})\.?)(\s*)(\d{{4}})\s*(\.?)\s*$"


def _year(text: Column) -> Column:
    """Two digits are of this century up to 68, else of the last."""
    n = text.cast("int")
    return F.when(F.length(text) > 2, n).when(n <= 68, n + 2000).otherwise(n + 1900)


def month_number(name: Column) -> Column:
    known = F.create_map(*[F.lit(x) for k, v in MONTH_OF.items() for x in (k, v)])
    return F.try_element_at(known, F.regexp_replace(F.lower(name), r"\.$", ""))


def parse(text: Column, month_first: bool = False) -> Column:
    """The date in a text of a day, month and year, or of a year alone (its first day); null for others.

    Numbers are day first, unless ``month_first``, which then holds where it makes a date.
    """
    part = lambda p, i: F.regexp_extract(text, p, i)
    whole = lambda p, i: F.nullif(part(p, i), F.lit("")).cast("int")

    def date(y: Column, m: Column, d: Column) -> Column:
        return F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")

    day_first = date(_year(part(DAY_FIRST, 5)), whole(DAY_FIRST, 3), whole(DAY_FIRST, 1))
    if month_first:
        day_first = F.coalesce(date(_year(part(DAY_FIRST, 5)), whole(DAY_FIRST, 1), whole(DAY_FIRST, 3)), day_first)
    return (
        F.when(text.rlike(DAY_FIRST), day_first)
        .when(text.rlike(YEAR_FIRST), date(whole(YEAR_FIRST, 1), whole(YEAR_FIRST, 3), whole(YEAR_FIRST, 5)))
        .when(text.rlike(NAMED), date(_year(part(NAMED, 5)), month_number(part(NAMED, 3)), whole(NAMED, 1)))
        .when(text.rlike(r"^\s*\d{4}\s*$"), date(F.trim(text).cast("int"), F.lit(1), F.lit(1)))
    )


def quarter(text: Column, month_first: bool = False) -> Column:
    """The first day of the date's quarter as dd.MM.yyyy; ``none`` where there is no date."""
    return F.coalesce(F.date_format(F.date_trunc("QUARTER", parse(text, month_first)), "dd.MM.yyyy"), F.lit("none"))


def partial(text: Column, days: Column, reference: str) -> Column:
    """Dates of day and month, or month and year, shifted in their layout; the missing part is the reference date's."""
    year, _, day = reference.split("-")
    part = lambda p, i: F.regexp_extract(text, p, i)
    number = lambda p, i: F.nullif(part(p, i), F.lit("")).cast("int")
    date = lambda y, m, d: F.date_add(F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd"), days)
    two = lambda old, n: F.when(F.length(old) == 2, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string"))
    a = date(F.lit(int(year)), number(DAY_MONTH, 3), number(DAY_MONTH, 1))
    b = date(number(MONTH_YEAR, 3), number(MONTH_YEAR, 1), F.lit(int(day)))
    c = date(number(NAMED_YEAR, 3), month_number(part(NAMED_YEAR, 1)), F.lit(int(day)))
    long = F.array(*[F.lit(m[0]) for m in MONTHS])
    return (
        F.when(text.rlike(MONTH_YEAR), F.concat(two(part(MONTH_YEAR, 1), F.month(b)), part(MONTH_YEAR, 2), F.year(b).cast("string"), part(MONTH_YEAR, 4)))
        .when(text.rlike(DAY_MONTH), F.concat(two(part(DAY_MONTH, 1), F.dayofmonth(a)), part(DAY_MONTH, 2), two(part(DAY_MONTH, 3), F.month(a)), part(DAY_MONTH, 4)))
        .when(text.rlike(NAMED_YEAR), F.concat(F.element_at(long, F.month(c)), part(NAMED_YEAR, 2), F.year(c).cast("string"), part(NAMED_YEAR, 4)))
    )


def shift(text: Column, days: Column | int, reference: str | None = None) -> Column:
    """The date so many days later, laid out as before; ``DATE`` where there is none.

    With a ``reference`` date (yyyy-MM-dd) also days and months without a year, and months
    with a year, take what they lack from it.

    Separators, the digits of the year, zeros before one-digit numbers, a month's long or
    short name and a dot at the end are kept.
    """
    days = F.lit(days) if isinstance(days, int) else days
    new = F.date_add(parse(text), days)
    part = lambda p, i: F.regexp_extract(text, p, i)
    year = lambda old: F.when(F.length(old) == 2, F.date_format(new, "yy")).otherwise(F.date_format(new, "yyyy"))
    two = lambda old, n: F.when(old.startswith("0") | (F.length(old) == 2), F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string"))
    long = F.array(*[F.lit(m[0]) for m in MONTHS])
    short = F.array(*[F.lit(m[-1]) for m in MONTHS])
    old_name = F.regexp_replace(part(NAMED, 3), r"\.$", "")
    is_long = reduce(Column.__or__, [F.lower(old_name) == m[0].lower() for m in MONTHS])
    name = F.concat(F.when(is_long, F.element_at(long, F.month(new))).otherwise(F.element_at(short, F.month(new))), F.regexp_extract(part(NAMED, 3), r"(\.?)$", 1))
    day, month = F.dayofmonth(new), F.month(new)
    out = (
        F.when(text.rlike(DAY_FIRST), F.concat(two(part(DAY_FIRST, 1), day), part(DAY_FIRST, 2), two(part(DAY_FIRST, 3), month), part(DAY_FIRST, 4), year(part(DAY_FIRST, 5)), part(DAY_FIRST, 6)))
        .when(text.rlike(YEAR_FIRST), F.concat(F.date_format(new, "yyyy"), part(YEAR_FIRST, 2), two(part(YEAR_FIRST, 3), month), part(YEAR_FIRST, 4), two(part(YEAR_FIRST, 5), day), part(YEAR_FIRST, 6)))
        .when(text.rlike(NAMED), F.concat(two(part(NAMED, 1), day), part(NAMED, 2), name, part(NAMED, 4), year(part(NAMED, 5)), part(NAMED, 6)))
        .otherwise(F.date_format(new, "yyyy"))
    )
    return F.coalesce(out, F.lit("DATE")) if reference is None else F.coalesce(out, partial(text, days, reference), F.lit("DATE"))
