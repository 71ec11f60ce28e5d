"""Names, phone numbers, normal forms and long documents."""

import time

import pytest
from pyspark.sql import functions as F

from textloom.functions import arrays, names, strings
from textloom.operators import pseudonyms, spans


@pytest.mark.parametrize(
    ("name", "parts"),
    [
        ("Maria hinter Berg", [("Maria", "FN"), ("hinter Berg", "LN")]),
        ("Anna nach Stein", [("Anna", "FN"), ("nach Stein", "LN")]),
        ("Peter los Angeles", [("Peter", "FN"), ("los Angeles", "LN")]),
        ("Berg, Anna Maria", [("Berg", "LN"), ("Anna", "FN"), ("Maria", "FN")]),
        ("Anna", [("Anna", "FN")]),
    ],
)
def test_name_roles(evaluate, name, parts):
    assert [tuple(x) for x in evaluate(lambda n: names.classify(n), n=name)] == parts


def test_titles_are_passed_over(evaluate):
    said = lambda *before: evaluate(lambda n: names.gender(n, F.array(*map(F.lit, before))), n="Kim Berg")
    assert said("Herr", "rer.", "nat.") == "male" and said("Frau", "Dr.", ",", "med.") == "female" and said("Herr", "Prof.") == "unknown" and said("Patientin") == "female"


@pytest.mark.parametrize(
    ("text", "parts"),
    [
        ("+49 (30) 123-456", ("+49", "30", "123456")), ("0049 30 1234", ("0049", "30", "1234")), ("030/1234", ("0", "30", "1234")), ("(030) 12 34", (None, "030", "1234")), ("  +1 (509) 555-6973 ", ("+1", "509", "5556973")),
        ("+4930123456", ("+493", "01234", "56")), ("12", (None, "1", "2")), ("+12", None), ("7", None), ("", None), ("abc", None), ("030 12x4", None), ("123456 7", (None, "12345", "67")), ("+49", ("+4", "9", None)),
    ],
)
def test_phone_numbers_in_parts(evaluate, text, parts):
    found = evaluate(strings.split_phone, t=text)
    if parts is None or parts[2] is None:
        assert found is None
    else:
        assert tuple(found) == parts


def test_normal_form(evaluate):
    assert evaluate(strings.normalise, t="Ärgeŕ Klein\n é ß") == "ärge klein ß"
    assert evaluate(strings.normalise, t="﻿Plain  Text!") == "plain text"


def test_running_sums(spark):
    frame = spark.createDataFrame([(list(range(n)),) for n in (0, 1, 5, 600)], "v array<bigint>")
    for fold in (4, 256):
        for r in frame.select("v", arrays.running(F.col("v"), fold).alias("s")).collect():
            assert r["s"] == [sum(r["v"][: i + 1]) for i in range(len(r["v"]))]


def test_many_spans_in_one_document(spark):
    n = 30_000
    docs = spark.createDataFrame([("d", "äb 12 " * n)], "doc string, text string")
    start = time.monotonic()
    found = spans.extract(docs, [("N", "[0-9]+")]).withColumn("replacement", F.lit("xyz"))
    out = pseudonyms.apply(docs.withColumn("_spans", F.lit(1)), found).first()
    assert out["text"] == "äb xyz " * n and len(out["moved"]) == n and out["moved"][-1]["end"] == 7 * n - 1 and time.monotonic() - start < 60


def test_overlapping_spans_as_by_brute_force(spark):
    import random

    r = random.Random(2)
    rows = []
    for i in range(60):
        n = r.choice((0, 1, 5, 700))
        rows.append((i, "".join(r.choice("abcä ") for _ in range(3000)), [(b, b + r.randint(1, 12), f"<{k}>") for k in range(n) for b in [r.randrange(2980)]]))
    frame = spark.createDataFrame(rows, "id int, text string, s array<struct<begin:int,end:int,replacement:string>>")
    for x in frame.select("id", spans.rewrite(F.col("text"), F.col("s")).alias("r")).collect():
        _, text, given = rows[x["id"]]
        out, at, places = "", 0, []
        for b, e, new in sorted(given, key=lambda s: (s[0], -s[1], s[2])):
            if b >= at:
                out += text[at:b]
                places.append((len(out), len(out) + len(new), b, e))
                out, at = out + new, e
        assert x["r"]["text"] == out + text[at:] and [tuple(p) for p in x["r"]["spans"]] == places
