"""String functions: masks, identifiers, contacts, normalisers and HTML."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.arrays import let
from textloom.functions.determinism import number

#: German mobile network prefixes.
MOBILE_PREFIXES = (
    "151", "152", "155", "156", "157", "159", "160", "162", "163", "170", "171", "172", "173", "174", "175", "176", "177", "178", "179",
)
#: What may stand between the groups of a phone number.
BETWEEN = " \t\n\r\f\x0b./-"
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"


def mask_x(covered: Column) -> Column:
    """One X for each code point."""
    return F.repeat(F.lit("X"), F.length(covered))


def mask_entity(kind: Column) -> Column:
    return F.coalesce(kind, F.lit("None"))


def placeholder(kind: Column, content: Column) -> Column:
    return F.format_string("[** %s %s **]", F.coalesce(kind, F.lit("None")), content)


def scramble(text: Column, seed: Column | str) -> Column:
    """Letters become other letters of the same case, digits digits; the rest stays.

    Letters beyond ASCII become ASCII ones. The i-th character depends on seed, text and i.
    """
    chars = F.split(text, "")

    def one(c: Column, i: Column) -> Column:
        h = number(F.lit(seed) if isinstance(seed, str) else seed, text, i.cast("string"))
        at = lambda letters: F.substring(F.lit(letters), (h % len(letters) + 1).cast("int"), F.lit(1))
        upper, lower = c.rlike(r"^\p{Lu}$"), c.rlike(r"^\p{Ll}$")
        return F.when(upper, at(UPPER)).when(lower, at(LOWER)).when(c.rlike(r"^\p{Nd}$"), at(DIGITS)).otherwise(c)

    return F.when(text == "", "").otherwise(F.array_join(F.transform(chars, one), ""))


def character_pattern(text: Column) -> Column:
    """Runs of upper, lower and digit characters as U, L, D with their length; a space is ``-``, others stay."""
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\p{Lu}", "\u0001"), r"\p{Ll}", "\u0002"), r"\p{Nd}", "\u0003"), " ", "-")
    runs = F.regexp_extract_all(classes, F.lit(r"(?s)\u0001+|\u0002+|\u0003+|."), F.lit(0))
    name = lambda r: F.element_at(F.create_map(F.lit("\u0001"), F.lit("U"), F.lit("\u0002"), F.lit("L"), F.lit("\u0003"), F.lit("D")), F.substring(r, 1, 1))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike(r"^[\u0001-\u0003]"), F.concat(name(r), F.length(r).cast("string"))).otherwise(r)), "")


def split_phone(text: Column) -> Column:
    """Struct of prefix (null without), area, subscriber; null where the text is no phone number.

    The prefix is ``+`` or ``00`` with up to three digits, or a single ``0``; the area has
    up to five digits and may stand in brackets; the subscriber is what digits follow. The
    prefix and the area take as many digits as they may, but leave one each for what comes
    after them.
    """
    run = lambda t: F.regexp_extract(t, "^[0-9]*", 0)
    count = lambda t: F.length(F.regexp_replace(t, "[^0-9]", ""))
    tail = lambda t, n: F.substring(t, n + 1, F.length(t))
    opened = lambda t: F.when(t.startswith("("), tail(t, F.lit(1))).otherwise(t)
    closed = lambda t: F.ltrim(F.when(t.startswith(")"), tail(t, F.lit(1))).otherwise(t), F.lit(BETWEEN))

    def rest_of(prefix: Column, after: Column) -> Column:
        """The parts, of what stands after a prefix; null if it is none."""

        def parts(digits: Column, taken: Column, subscriber: Column) -> Column:
            good = (taken > 0) & subscriber.rlike("^[0-9]") & (F.translate(subscriber, "0123456789" + BETWEEN, "") == "")
            return F.when(good, F.struct(prefix.alias("prefix"), F.substring(digits, F.lit(1), taken).alias("area"), F.regexp_replace(subscriber, "[^0-9]", "").alias("subscriber")))

        taken = lambda digits: F.least(F.lit(5), F.length(run(digits)), count(digits) - 1)
        return let(let(F.ltrim(after, F.lit(BETWEEN)), opened), lambda d: let(taken(d), lambda n: let(closed(tail(d, n)), lambda rest: parts(d, n, rest))))

    def international(body: Column, sign: str) -> Column:
        after = tail(body, F.lit(len(sign)))
        taken = F.when(body.startswith(sign), F.least(F.lit(3), F.length(run(after)), count(after) - 2)).otherwise(0)
        return let(taken, lambda n: F.when(n > 0, rest_of(F.substring(body, F.lit(1), n + len(sign)), tail(body, n + len(sign)))))

    def split(body: Column) -> Column:
        trunk = F.when(body.startswith("0"), rest_of(F.lit("0"), tail(body, F.lit(1))))
        return F.coalesce(international(body, "+"), international(body, "00"), trunk, rest_of(F.lit(None).cast("string"), body))

    return let(F.btrim(text, F.lit(BETWEEN)), split)


def phone_surrogate(parts: Column, area: Column, seed: str) -> Column:
    """Prefix, new area (a mobile prefix where there is none), scrambled subscriber; no separators."""
    mobile = lambda x: F.element_at(F.array(*map(F.lit, MOBILE_PREFIXES)), (number(F.lit(seed), x["area"]) % len(MOBILE_PREFIXES) + 1).cast("int"))
    return let(parts, lambda x: F.concat_ws("", x["prefix"], F.coalesce(area, mobile(x)), scramble(x["subscriber"], seed)))


def contact_surrogate(text: Column, entries: Column, kept: Sequence[str], seed: str) -> Column:
    """A mail address or URL with its parts replaced one after another, in all their places.

    ``entries`` is a map from lower-case words to their surrogates. Parts are what stands
    between non-word characters; the last one and those in ``kept`` stay, others get the
    entry or a scramble. A later part can match within an earlier one's surrogate, so
    they are taken in their order. Spaces are removed at the end.
    """
    parts = F.filter(F.split(text, r"(?U)\W+"), lambda p: p != "")
    stay = F.array(*map(F.lit, kept)) if kept else F.array().cast("array<string>")
    change = F.filter(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: ~F.array_contains(stay, F.lower(p)))
    new = lambda p: F.coalesce(F.element_at(entries, F.lower(p)), scramble(p, seed))
    return F.regexp_replace(F.aggregate(change, text, lambda a, p: F.replace(a, p, new(p))), " ", "")


MAIL_KEPT = ("klinik", "klinikum", "krankenhaus")
URL_KEPT = (*MAIL_KEPT, "www", "http", "https")


def strip_prefix(code: Column, prefix: str) -> Column:
    """``code`` without ``prefix``, which is taken to end in a slash."""
    full = prefix if prefix.endswith("/") else prefix + "/"
    return F.when(code.startswith(full), F.substring(code, F.lit(len(full) + 1), F.length(code))).otherwise(code)


@F.pandas_udf(T.StringType())
def _composed(text: pd.Series) -> pd.Series:
    """Letters with their marks in one character, as far as there is one."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def composed(text: Column) -> Column:
    """Normal form C, of texts with marks that stand apart or the Kelvin sign; others go through no Python."""
    apart = text.rlike("[\\p{M}\u212a]")
    return F.when(apart, _composed(F.when(apart, text))).otherwise(text)


def normalise(text: Column) -> Column:
    """Lower-case letters, digits and a few signs with single spaces, in normal form C; line ends are spaces, control characters go."""
    flat = F.regexp_replace(F.regexp_replace(F.regexp_replace(composed(text), "\ufeff", ""), r"[\r\n]+", " "), r"[\x00-\x1F\x7F]", "")
    kept = F.regexp_replace(flat, r"[^A-Za-z0-9ÄÖÜäöüßẞ .,&/()\-]", "")
    return F.trim(F.regexp_replace(F.lower(kept), " +", " "))


def main_name(text: Column) -> Column:
    return F.trim(F.substring_index(text, "/", 1))


def expand_abbreviations(text: Column, names: Sequence[tuple[str, str]]) -> Column:
    """Whole words replaced, the longest first; case counts."""
    quote = lambda s: r"\Q" + s + r"\E"
    word = r"(?<![\p{L}\p{N}_])%s(?![\p{L}\p{N}_])"
    return reduce(lambda t, p: F.regexp_replace(t, word % quote(p[0]), p[1].replace("\\", r"\\").replace("$", r"\$")), sorted(names, key=lambda p: -len(p[0])), text)


def street(name: Column) -> Column:
    """Struct of the street in full spelling, and whether a number stands behind it."""
    body = F.trim(F.regexp_extract(F.trim(name), r"^(\D+?)\s*(\d.*)?$", 1))
    long = F.regexp_replace(F.regexp_replace(body, r"Str\.?$", "Straße"), r"str\.?$", "straße")
    return F.struct(long.alias("name"), name.rlike(r"\d").alias("has_number"))


def remove_phrases(text: Column, patterns: Sequence[str]) -> Column:
    """Each pattern's matches removed, in order."""
    return reduce(lambda t, p: F.regexp_replace(t, p, ""), patterns, text)


#: (pattern, replacement), in order
HTML_STEPS = (
    *[(rf"(?is)<{t}\b.*?</{t}>", "") for t in ("script", "style", "head")],
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<(?:td|th)\b[^>]*\bcolspan\b[^>]*>.*?</(?:td|th)>", ""),
    (r"(?is)\s*<li\b[^>]*>\s*", "\n  - "),
    (r"(?is)</t[dh]>\s*<t[dh]\b[^>]*>", " | "),
    (r"(?is)<br\s*/?>|</(?:p|div|tr|h[1-6]|ul|ol|table|li|title)>", "\n"),
    (r"(?is)<h[1-6]\b[^>]*>", "\n"),
    (r"(?s)<[^>]*>", ""),
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&amp;", "&"),
    (r"[ \t]+", " "),
    (r" ?\n\s*", "\n"),
)


def html_to_text(html: Column) -> Column:
    """Readable text of simple pages: bullets for list items, lines for headings and rows, `` | `` between cells."""
    return F.trim(reduce(lambda t, s: F.regexp_replace(t, s[0], s[1]), HTML_STEPS, html))


def semantic_tag(fsn: Column) -> Column:
    """What stands between the first ``(`` and the next ``)``; empty without."""
    return F.regexp_extract(fsn, r"\(([^)]*)", 1)


def tag_pattern(tags: Sequence[str]) -> str:
    """Pattern for names with one of the tags in parentheses; white space within a tag is any."""
    import re

    one = lambda t: r"\s+".join(re.escape(w) for w in t.split())
    return r"(?i)\((?:" + "|".join(one(t) for t in tags) + r")\)"


def has_tag(fsn: Column, tags: Sequence[str] | None, positive: bool = True) -> Column:
    """Whether a name has one of the tags (or none, if not ``positive``); true for all without tags."""
    if tags is None:
        return F.lit(True)
    if not tags:
        return F.lit(not positive)
    return fsn.rlike(tag_pattern(tags)) if positive else ~fsn.rlike(tag_pattern(tags))


def similarity(a: Column, b: Column) -> Column:
    """Edit distance over the longer length; 0 for two empty strings."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(0.0)).otherwise(F.levenshtein(a, b) / longest)


def best_match_similarity(target: Column, candidate: Column) -> Column:
    """1 less the mean, over the target's terms, of the least distance to a candidate's; 0 if either has none."""
    least = F.transform(target, lambda x: F.array_min(F.transform(candidate, lambda y: similarity(x, y))))
    total = F.aggregate(least, F.lit(0.0), lambda a, x: a + x)
    return F.when((F.size(target) > 0) & (F.size(candidate) > 0), 1 - total / F.size(target)).otherwise(F.lit(0.0))


def parse_boolean(text: str | None) -> bool | None:
    """German and English words for yes and no; other strings are None, other values True."""
    if not isinstance(text, str):
        return True
    return {**dict.fromkeys(("true", "yes", "y", "j", "ja"), True), **dict.fromkeys(("false", "no", "n", "nein"), False)}.get(text.lower())
