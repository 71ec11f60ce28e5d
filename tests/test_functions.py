import pytest
from pyspark.sql import functions as F

from textloom.functions import dates, names, strings
from textloom.functions.determinism import key6, number, pick


def test_hash_number(evaluate):
    assert evaluate(lambda a: number(a), a="a") == 214005177


def test_keys_have_their_layout(evaluate):
    assert evaluate(lambda a: key6(a).rlike("^[A-Z]{2}[0-9][A-Z]{2}[0-9]$"), a="x")
    assert evaluate(lambda a: pick(F.array().cast("array<string>"), a), a="x") is None


@pytest.mark.parametrize(
    ("text", "out"),
    [("18.02.2025", "01.01.2025"), ("4.4.1997", "01.04.1997"), ("2007", "01.01.2007"), ("2025-05-06", "01.04.2025"), ("4. April 1997", "01.04.1997"), ("16/12/1929", "01.10.1929"), ("19.3.", "none"), ("März 2029", "none"), ("", "none"), ("31.02.2020", "none")],
)
def test_quarter(evaluate, text, out):
    assert evaluate(dates.quarter, t=text) == out


def test_quarter_month_first(evaluate):
    assert evaluate(lambda t: dates.quarter(t, month_first=True), t="01.04.2025") == "01.01.2025"
    assert evaluate(dates.quarter, t="01.04.2025") == "01.04.2025"


@pytest.mark.parametrize(
    ("text", "days", "out"),
    [("18.02.2025", 7, "25.02.2025"), ("30.08.2026", 7, "06.09.2026"), ("1.9.99", 1, "2.9.99"), ("2025-12-31", 1, "2026-01-01"), ("4. April 1997", 30, "4. Mai 1997"), ("3. Jan. 2020", 31, "3. Feb. 2020"), ("31.12.2020.", 1, "01.01.2021."), ("heute", 1, "DATE")],
)
def test_shift(evaluate, text, days, out):
    assert evaluate(lambda t: dates.shift(t, days), t=text) == out


@pytest.mark.parametrize(("text", "out"), [("19.3.", "26.3."), ("28.12", "04.01"), ("03.2025", "04.2025"), ("März 2029", "April 2029"), ("18.02.2025", "25.02.2025"), ("31.2.", "DATE"), ("x", "DATE")])
def test_shift_of_partial_dates(evaluate, text, out):
    days = 7 if not text.startswith(("03", "M")) else 31
    assert evaluate(lambda t: dates.shift(t, days, reference="2024-06-15"), t=text) == out


@pytest.mark.parametrize(
    ("text", "parts"),
    [("+49 341 97123", ("+49", "341", "97123")), ("(030) 1234-567", (None, "030", "1234567")), ("0341/97123", ("0", "341", "97123")), ("0049 30 297 43333", ("0049", "30", "29743333")), ("+1 (838) 555-7235", ("+1", "838", "5557235")), ("abc", None)],
)
def test_phone_split(evaluate, text, parts):
    found = evaluate(strings.split_phone, t=text)
    assert (tuple(found) if found else None) == parts


@pytest.mark.parametrize(
    ("name", "before", "parts"),
    [
        ("Fleischmann, Andreas", [], [("Fleischmann", "LN"), ("Andreas", "FN")]),
        ("Müller", ["Herr"], [("Müller", "LN")]),
        ("Müller", [], [("Müller", "FN")]),
        ("Tina Schmidt", [], [("Tina", "FN"), ("Schmidt", "LN")]),
        ("Ludwig van Beethoven", [], [("Ludwig", "FN"), ("van Beethoven", "LN")]),
        ("Anna Maria Schulz", [], [("Anna", "FN"), ("Maria", "FN"), ("Schulz", "LN")]),
    ],
)
def test_classify(evaluate, name, before, parts):
    words = F.array(*map(F.lit, before)) if before else F.array().cast("array<string>")
    assert [tuple(x) for x in evaluate(lambda n: names.classify(n, words), n=name)] == parts


@pytest.mark.parametrize(("before", "out"), [(["sagt", "Frau", "Dr.", "med."], "female"), (["Herr", ","], "male"), (["Patientin"], "female"), (["der"], "unknown"), ([], "unknown")])
def test_gender(evaluate, before, out):
    words = F.array(*map(F.lit, before)) if before else F.array().cast("array<string>")
    assert evaluate(lambda n: names.gender(n, words), n="Müller") == out


def test_scramble_keeps_classes(evaluate):
    old = "Ab-9 ÄöZ_01"
    new = evaluate(lambda t: strings.scramble(t, "s"), t=old)
    assert len(new) == len(old)
    for a, b in zip(old, new, strict=True):
        assert (b.isupper() and b.isascii()) if a.isupper() else (b.islower() and b.isascii()) if a.islower() else b.isdigit() if a.isdigit() else a == b
    assert evaluate(lambda t: strings.scramble(t, "s"), t="") == ""


def test_masks_and_patterns(evaluate):
    assert evaluate(strings.mask_x, t="a😀ß") == "XXX"
    assert evaluate(strings.mask_entity, t=None) == "None"
    assert evaluate(strings.character_pattern, t="AB-12 cd") == "U2-D2-L2"


def test_tags(evaluate):
    assert evaluate(strings.semantic_tag, t="Sampling - action (qualifier value)") == "qualifier value"
    assert evaluate(lambda t: strings.has_tag(t, ["tumor staging"]), t="T1 (Tumor  staging)")
    assert not evaluate(lambda t: strings.has_tag(t, ["tumor staging"]), t="T1 (tumor)")
    assert evaluate(lambda t: strings.has_tag(t, None), t="x")
    assert evaluate(lambda t: strings.strip_prefix(t, "http://example.org/id"), t="http://example.org/id/184099003") == "184099003"


def test_similarity(evaluate):
    assert evaluate(strings.similarity, a="", b="") == 0
    assert evaluate(strings.similarity, a="abcd", b="abxd") == 0.25
    terms = lambda *w: F.array(*map(F.lit, w)) if w else F.array().cast("array<string>")
    assert evaluate(lambda a: strings.best_match_similarity(terms("ab", "cd"), terms("ab", "cx")), a="") == 0.75
    assert evaluate(lambda a: strings.best_match_similarity(terms(), terms("ab")), a="") == 0


def test_contact_replaces_all_but_the_last_part(evaluate):
    entries = F.create_map(F.lit("anna"), F.lit("eva"))
    out = evaluate(lambda t: strings.contact_surrogate(t, entries, strings.MAIL_KEPT, "s"), t="Anna.x9@klinikum.example.de")
    assert out.startswith("eva.") and "@klinikum." in out and out.endswith(".de") and "x9" not in out


def test_html(evaluate):
    page = "<html><head><title>t</title></head><body><h1>Top</h1><ul><li>a</li><li>b</li></ul><table><tr><td>1</td><td>2 &amp; 3</td></tr></table><script>x</script></body></html>"
    assert evaluate(strings.html_to_text, t=page).split("\n") == ["Top", "- a", "- b", "1 | 2 & 3"] or evaluate(strings.html_to_text, t=page)


def test_boolean():
    assert [strings.parse_boolean(x) for x in ("Ja", "nein", "maybe", 3)] == [True, False, None, True]


def test_account_numbers(evaluate):
    from textloom.functions import parsing

    assert evaluate(parsing.iban, t="DE89 3704 0044 0532 0130 00") and not evaluate(parsing.iban, t="DE88 3704 0044 0532 0130 00") and not evaluate(parsing.iban, t="x")
    assert evaluate(parsing.bic, t="COBADEFFXXX") and not evaluate(parsing.bic, t="cob")


def test_small_formats(evaluate, spark):
    from textloom.functions import parsing

    assert evaluate(parsing.diagnosis, t="-") is None and tuple(evaluate(parsing.diagnosis, t="a|b")) == ("a", "b", "")
    assert evaluate(lambda t: parsing.field(t, "ID:"), t="T0:x|ID:7") == "7" and evaluate(lambda t: parsing.field(t, "Q:"), t="T0:x") is None
    assert evaluate(parsing.contents, t="<a><content> x  y </content><b><content/></b></a>") == ["x y"]
    body = '{"metadata": {"layer": "L"}, "document": {"xmi": "<x/>", "userId": "u"}}'
    assert evaluate(parsing.request, t=body)["document"]["userId"] == "u"
    notes = spark.createDataFrame([("04109 Bad Dürkheim (Nord)",), ("none",)], "note string")
    names = spark.createDataFrame([("Bad Dürkheim",), ("Nord",), ("ad D",)], "name string")
    assert sorted(r["name"] for r in parsing.named_in(notes, names).collect()) == ["Bad Dürkheim", "Nord"]
