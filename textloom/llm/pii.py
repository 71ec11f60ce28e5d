"""Personal data by weak supervision, in DataFrame functions only.

Candidates of patterns and of a gazetteer of names get votes of labelers: validity,
gazetteer, context for and against on both sides, and shape;
expectation-maximisation over the counts of vote patterns estimates how reliable each
labeler is for each kind, and its posteriors train the final span classifier, whose
weights are written into the plan.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import fresh

KINDS = ("email", "ip", "card", "phone", "secret", "name")
#: (kind, pattern, a string every match has, or a pattern for one). Possessive: nothing after them could need what they took,
#: and Java's ordinary repeated groups use the stack. \G and the lookbehind start an email only where a run of its
#: characters starts or the last match ended: other starts within the run fail as well.
BASE = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", None),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", None),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
)
MORE = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]{1,63}){1,8}", "at"),
    ("phone", r"(?<![0-9+().-])(?<![0-9)]\x20)(?:\([0-9]{3}\)\x20?|[0-9]{3}-)[0-9]{3}-[0-9]{4}(?![0-9-])", None),
    ("secret", r"(?<![A-Za-z])(?:password|passwd|secret|token|api[_-]?key)\x20?[=:]\x20?[\"']?[A-Za-z0-9/+_-]{8,256}[\"']?", None),
    ("secret", r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])", "AKIA"),
)
#: The gazetteers: entries that a span of the kind has at the place that LISTED tells.
GAZETTEER = {
    "email": "com org net edu gov info io co app dev de fr es uk it nl eu ch at us ca au be se no dk fi pl pt br mx in jp cn".split(),
    "card": "4 51 52 53 54 55 22 23 24 25 26 27 34 37 6011 65 36 38 35".split(),
    "phone": "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split(),
    "secret": "password passwd secret token api AKIA".split(),
    "name": (
        "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica Thomas Sarah Charles Karen "
        "Daniel Nancy Matthew Lisa Anthony Margaret Mark Sandra Paul Ashley Steven Emily Andrew Donna George Michelle Kenneth Carol Peter Anna Hans Karl "
        "Klaus Ursula Sabine Jürgen Heike Stefan Monika Pierre Jean Marie Jacques Camille Luc Sophie Juan José Carmen Javier Lucía Pablo Elena Miguel"
    ).split(),
}
#: Where an entry stands in a span, as a pattern with a place for the entries; for ip, ranges that no one's address is from.
LISTED = {
    "email": r"(?i)[.\x20](?:{})$",
    "ip": r"^(?!0|10\.|127\.|192\.168\.|169\.254\.|22[4-9]\.|2[3-9][0-9]\.)",
    "card": r"^(?:{})",
    "phone": r"^(?:\+(?:{})|[(0-9])",
    "secret": r"^(?:{})",
    "name": r"^(?:{})\x20",
}
MORE += (("name", rf"(?<!\p{{L}})(?=[A-Z])(?:{'|'.join(GAZETTEER['name'])})\x20\p{{Lu}}\p{{Ll}}{{2,30}}(?!\p{{L}})", "\x20"),)
#: Words that stand near a span of the kind: up to 24 characters before it or 16 after it in its line.
CUES = {
    "email": "mail|email|e-mail|contact|write|kontakt|correo|courriel|from|to|cc|reply",
    "ip": "ip|address|host|server|adresse|dirección|client|login|connection|subnet",
    "card": "card|visa|mastercard|amex|credit|karte|carte|tarjeta|payment|paid|cvv|expires",
    "phone": "phone|tel|call|mobile|cell|fax|telefon|teléfono|téléphone|fono|whatsapp|number",
    "secret": "key|keys|secret|credential|credentials|login|pass|config|export|auth",
    "name": "mr|mrs|ms|dr|prof|herr|frau|mme|sr|sra|name|named|by|author|patient|dear|signed|born|contact",
}
AGAINST = "version|isbn|order|invoice|no|nr|figure|page|chapter|serial|build|street|avenue|saint|park"


def listed_pattern(kind: str) -> str:
    return LISTED[kind].replace("{}", "|".join(GAZETTEER.get(kind, ())))


def near_before(words: str, most: int) -> str:
    return rf"(?i)(?<![\p{{L}}])(?:{words})(?!\p{{L}})[^\n]{{0,{most}}}$"


def near_after(words: str, most: int) -> str:
    return rf"(?i)^[^\n]{{0,{most}}}(?<!\p{{L}})(?:{words})(?!\p{{L}})"


LABELERS = ("valid", "listed", "said", "unsaid", "shaped")
#: Characters before and after a candidate that context labelers see; matches that one fold numbers.
BEFORE, AFTER, FOLD = 48, 32, 256
ACCEPT = 0.9


def kind_number(kind: str) -> int:
    return KINDS.index(kind)


def starts(before: Column, matches: Column) -> Column:
    """Start of each match in code points, from the texts before each and the matches, in folds of bounded length."""
    steps = F.zip_with(before, matches, lambda g, m: (F.length(g) + F.length(m)).cast("long"))
    folds = F.sequence(F.lit(0), F.ceil(F.size(matches) / FOLD).cast("int") - 1)
    part = lambda b: F.slice(steps, b * FOLD + 1, F.lit(FOLD))
    none = F.array().cast("array<bigint>")

    def running(values: Column, start: Column) -> Column:
        zero = F.struct(start.alias("at"), none.alias("out"))
        return F.aggregate(values, zero, lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])

    offsets = running(F.transform(folds, lambda b: F.aggregate(part(b), F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0).cast("long"))
    ends = F.flatten(F.transform(F.arrays_zip(folds.alias("b"), offsets.alias("o")), lambda z: running(part(z["b"]), z["o"])))
    return F.zip_with(ends, before, lambda e, g: e + F.length(g))


EMPTY = "array<struct<kind:int,start:bigint,end:bigint,text:string,before:string,after:string>>"


def found(text: Column, kind: str, pattern: str, needs: str | None) -> Column:
    """Leftmost matches without overlap: array of kind, start, end, text, and what stands before and after."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    heads = F.slice(gaps, F.lit(1), F.size(matches))
    tails = F.slice(gaps, F.lit(2), F.size(matches))
    all_ = F.transform(
        F.arrays_zip(matches.alias("m"), starts(heads, matches).alias("s"), heads.alias("g"), tails.alias("n")),
        lambda z: F.struct(
            F.lit(kind_number(kind)).alias("kind"),
            z["s"].alias("start"),
            (z["s"] + F.length(z["m"])).alias("end"),
            z["m"].alias("text"),
            F.substring(z["g"], -BEFORE, BEFORE).alias("before"),
            F.substring(z["n"], 1, AFTER).alias("after"),
        ),
    )
    there = text.rlike("[=:]") if kind == "secret" and not needs else text.contains(needs) if needs else text.rlike("[0-9]")
    return F.when(there & text.rlike(pattern), all_).otherwise(F.array().cast(EMPTY))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of 1 to 19 digits passes the check sum; other lengths don't."""
    turned = F.reverse(number)

    def step(a: Column, i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return a + d - F.when(d > 9, 9).otherwise(0)

    total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), step)
    return F.when(F.length(number).between(1, 19), total % 10 == 0).otherwise(F.lit(False))


def by_kind(x: Column, cases: dict[str, Column], other: Column) -> Column:
    return reduce(lambda rest, k: F.when(x["kind"] == kind_number(k), cases[k]).otherwise(rest), cases, other)


def valid(x: Column) -> Column:
    """The contract's check of a base match: address parts at most 255, 12 to 19 digits that pass Luhn, 9 to 15 digits."""
    t = x["text"]
    n = F.length(digits(t))
    octet = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    return by_kind(x, {"ip": t.rlike(rf"^{octet}(?:\.{octet}){{3}}$"), "card": F.when(n.between(12, 19), luhn(digits(t))).otherwise(False), "phone": n.between(9, 15)}, F.lit(True))


def votes(x: Column) -> dict[str, Column]:
    """1, -1 or 0 (abstains) of each labeler."""
    t, before, after = x["text"], x["before"], x["after"]
    yes = lambda c, no: F.when(c, 1).otherwise(no)
    shape = {
        "email": t.rlike("^[^@]*[A-Za-z].*$"),
        "ip": ~t.rlike(r"(?:^|\.)0[0-9]"),
        "card": F.length(digits(t)).isin(15, 16),
        "phone": F.length(digits(t)).between(10, 13),
        "secret": t.rlike("[0-9]") & t.rlike("[A-Za-z]"),
        "name": F.length(t).between(7, 40),
    }
    cued = {k: before.rlike(near_before(w, 24)) | after.rlike(near_after(w, 16)) for k, w in CUES.items()}
    return {
        "valid": yes(valid(x), -1),
        "listed": yes(by_kind(x, {k: t.rlike(listed_pattern(k)) for k in KINDS}, F.lit(False)), -1),
        "said": yes(by_kind(x, cued, F.lit(False)), 0),
        "unsaid": F.when(before.rlike(near_before(AGAINST, 3)), -1).otherwise(0),
        "shaped": yes(by_kind(x, shape, F.lit(False)), -1),
    }


def marks(x: Column) -> dict[str, Column]:
    """What the classifier sees beside the votes: the characters next to the span."""
    word = r"^[A-Za-z0-9]$"
    return {"joined_before": F.substring(x["before"], -1, 1).rlike(word), "joined_after": F.substring(x["after"], 1, 1).rlike(word)}


def estimate(rows: Sequence[tuple[int, tuple[int, ...], int]], rounds: int = 50) -> dict[tuple[int, tuple[int, ...]], float]:
    """Posterior that a candidate is personal data, by kind and votes, from counted (kind, votes, n).

    Two classes; each labeler's votes are independent given the class. Beta-like
    pseudo-counts say that a labeler is right more often than wrong, which fixes which
    class is which and decides where there are few rows.
    """
    kinds = sorted({k for k, _, _ in rows})
    out = {}
    for kind in kinds:
        own = [(v, n) for k, v, n in rows if k == kind]
        post = {v: min(0.95, max(0.05, 0.5 + 0.25 * v[0] + 0.1 * sum(v[1:]))) for v, _ in own}
        size = len(own[0][0])
        for _ in range(rounds):
            prior = (sum(n * post[v] for v, n in own) + 1) / (sum(n for _, n in own) + 2)
            table = []
            for j in range(size):
                t = {}
                for vote in (-1, 0, 1):
                    hit = sum(n * post[v] for v, n in own if v[j] == vote)
                    miss = sum(n * (1 - post[v]) for v, n in own if v[j] == vote)
                    t[vote] = (hit + (8, 4, 2)[1 - vote], miss + (2, 4, 8)[1 - vote])
                both = [sum(t[x][c] for x in t) for c in (0, 1)]
                table.append({x: (t[x][0] / both[0], t[x][1] / both[1]) for x in t})
            for v, _ in own:
                log = math.log(prior) - math.log(1 - prior) + sum(math.log(table[j][v[j]][0]) - math.log(table[j][v[j]][1]) for j in range(size))
                post[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, log))))
        out |= {(kind, v): p for v, p in post.items()}
    return out


def fit(rows: Sequence[tuple[list[float], float, float]], steps: int = 300, decay: float = 1e-3) -> list[float]:
    """Logistic regression on (features, target between 0 and 1, weight), by accelerated gradient steps."""
    size = len(rows[0][0])
    total = sum(w for _, _, w in rows)
    sharp = max(sum(f * f for f in x) for x, _, _ in rows) / 4 + decay
    w, ahead = [0.0] * size, [0.0] * size
    for i in range(steps):
        slope = [decay * a for a in ahead]
        for x, y, n in rows:
            z = sum(a * f for a, f in zip(ahead, x, strict=True))
            g = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y) * n / total
            for j, f in enumerate(x):
                slope[j] += g * f
        new = [a - s / sharp for a, s in zip(ahead, slope, strict=True)]
        ahead = [n + i / (i + 3) * (n - o) for n, o in zip(new, w, strict=True)]
        w = new
    return w


def names() -> list[str]:
    return [*(f"is_{k}" for k in KINDS), *LABELERS, "joined_before", "joined_after"]


def train(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """Weights of the span classifier, from all candidates of all rows.

    What comes to the driver are counts by kind, votes and marks: at most 6 * 3^5 * 4
    rows whatever the input. The classifier takes each such pattern with the square root
    of its count as weight, so that a frequent one doesn't drown those that are rare; the
    estimates before it count every candidate. Without candidates all weights are 0.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    every = docs.select(F.explode(F.concat(*[found(t, *p) for p in (*BASE, *MORE)])).alias("x"))
    x = F.col("x")
    keys = {**votes(x), **marks(x)}
    counted = every.select(x["kind"].alias("kind"), *[c.alias(n) for n, c in keys.items()]).groupBy("kind", *keys).count()
    rows = sorted(tuple(r) for r in counted.collect())
    if not rows:
        return dict.fromkeys(names(), 0.0)
    by: dict[tuple[int, tuple[int, ...]], int] = {}
    for r in rows:
        by[r[0], r[1:6]] = by.get((r[0], r[1:6]), 0) + r[8]
    post = estimate([(k, v, n) for (k, v), n in sorted(by.items())])
    made = [([*(float(r[0] == i) for i in range(len(KINDS))), *map(float, r[1:6]), float(r[6]), float(r[7])], post[r[0], r[1:6]], math.sqrt(r[8])) for r in rows]
    return dict(zip(names(), fit(made), strict=True))


def likelihood(x: Column, weights: dict[str, float]) -> Column:
    kind = by_kind(x, {k: F.lit(weights[f"is_{k}"]) for k in KINDS}, F.lit(0.0))
    parts = [weights[n] * c.cast("double") for n, c in {**votes(x), **marks(x)}.items()]
    return 1 / (1 + F.exp(-reduce(Column.__add__, parts, kind)))


def scan(docs: DataFrame, weights: dict[str, float] | None = None, text: str = "text", into: str = "pii") -> DataFrame:
    """Add a struct of two arrays, base and spans, of (start, kind, end): kind is a number of KINDS, offsets are in code points.

    Base spans are the contract's; spans has them all, and those further candidates that
    the classifier accepts and that overlap no base span and no earlier further one.
    Null is an empty text. Every row and column stays.
    """
    if fresh(docs.columns, into) != into:
        raise ValueError(f"the column {into} exists")
    weights = train(docs, text) if weights is None else weights
    base_, more_, free_ = (fresh(docs.columns, c) for c in ("base", "more", "free"))
    t = F.coalesce(F.col(text), F.lit(""))
    slim: Callable[[Column], Column] = lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))
    spans = lambda pattern, test: F.transform(F.filter(found(t, *pattern), test), slim)
    rows = docs.withColumn(base_, F.array_sort(F.concat(*[spans(p, valid) for p in BASE])))
    rows = rows.withColumn(more_, F.array_sort(F.concat(*[spans(p, lambda x: likelihood(x, weights) >= ACCEPT) for p in MORE])))
    rows = rows.withColumn(free_, F.filter(more_, lambda m: ~F.exists(base_, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))))
    first = F.filter(free_, lambda m: ~F.exists(free_, lambda o: (o < m) & (o["start"] < m["end"]) & (m["start"] < o["end"])))
    out = F.struct(F.col(base_).alias("base"), F.array_sort(F.concat(F.col(base_), F.when(F.size(free_) > 0, first).otherwise(F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))).alias("spans"))
    return rows.withColumn(into, out).drop(base_, more_, free_)


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind_number(kind))).cast("long")


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kind = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", kind(x), x["start"].cast("string"), x["end"].cast("string"))))
