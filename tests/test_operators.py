import pytest
from pyspark.sql import functions as F

from textloom.operators import lookups, mapping, nearest, places, pseudonyms, quality, spans, terminology
from textloom.plans import deidentify


@pytest.fixture
def notes(spark):
    docs = spark.createDataFrame([("a", "geb. am 18.02.2025, Ort"), ("b", "Frau Müller 😀 kam."), ("c", "nichts"), ("d", None)], "doc string, text string")
    found = spark.createDataFrame([("a", 8, 18, "DATE_BIRTH", "18.02.2025"), ("b", 5, 11, "NAME_PATIENT", "Müller"), ("b", 14, 17, "OTHER", "kam")], "doc string, begin int, end int, kind string, text string")
    return docs, found


@pytest.mark.parametrize(("mode", "out"), [("x", "geb. am XXXXXXXXXX, Ort"), ("entity", "geb. am DATE_BIRTH, Ort"), ("keyed", "geb. am [** DATE_BIRTH 01.01.2025 **], Ort")])
def test_modes(notes, mode, out):
    docs, found = notes
    made = pseudonyms.apply(docs, pseudonyms.replacements(found, mode, "s"))
    rows = {r["doc"]: r for r in made.collect()}
    assert rows["a"]["text"] == out and rows["c"]["text"] == "nichts" and rows["d"]["text"] is None
    moved = rows["a"]["moved"][0]
    assert rows["a"]["text"][moved["begin"] : moved["end"]] == out[8 : 8 + len(out) - len("geb. am , Ort")]


def test_surrogates_do_not_leak_unknown_kinds(notes, spark):
    docs, found = notes
    known = spark.createDataFrame([("NAME_PATIENT", "Müller", "Ahorn")], "kind string, text string, surrogate string")
    made = pseudonyms.apply(docs, pseudonyms.replacements(found, "surrogate", surrogates=known, days=7))
    rows = {r["doc"]: r["text"] for r in made.collect()}
    assert rows["b"] == "Frau Ahorn 😀 [OTHER]." and rows["a"] == "geb. am 25.02.2025, Ort"


def test_gate_drops_wrong_documents(notes):
    docs, found = notes
    run = deidentify.run(docs, found, "x", "s")
    assert [r["doc"] for r in run.documents.collect()] == ["a"]
    assert {r["doc"]: r["part_of_corpus"] for r in run.verdicts.collect()} == {"a": 1, "b": 0}


def test_nested_spans_count_for_each_container(spark):
    rows = spark.createDataFrame([("d", 0, 10, "A"), ("d", 2, 5, "B"), ("d", 20, 25, "C")], "doc string, begin int, end int, kind string")
    assert {r["kind"]: r["n"] for r in quality.nested_counts(rows).collect()} == {"A": 1, "B": 2, "C": 1}


def test_outermost_wins(spark):
    one = spark.createDataFrame([("0123456789",)], "text string").withColumn("s", F.expr("array(struct(2 AS begin, 4 AS end, 'in' AS replacement), struct(1 AS begin, 6 AS end, 'OUT' AS replacement), struct(6 AS begin, 6 AS end, '+' AS replacement))"))
    assert one.select(spans.rewrite(F.col("text"), F.col("s")).alias("x")).first()["x"]["text"] == "0OUT+6789"


def test_matches_count_code_points(spark):
    found = spans.extract(spark.createDataFrame([("d", "😀 a1 😀😀 b2"), ("e", ""), ("f", None)], "doc string, text string"), [("X", "[a-z][0-9]")])
    assert [(r["begin"], r["end"], r["text"]) for r in found.orderBy("begin").collect()] == [(2, 4, "a1"), (8, 10, "b2")]


def test_preceding_is_bounded_by_k(spark):
    tokens = spark.createDataFrame([("d", i, i + 1, str(i)) for i in range(10)], "doc string, begin int, end int, text string")
    at = spark.createDataFrame([("d", 7, 9, "x"), ("d", 2, 3, "y"), ("e", 0, 1, "z")], "doc string, begin int, end int, name string")
    rows = {r["name"]: r["before"] for r in spans.preceding(at, tokens).collect()}
    assert rows == {"x": ["2", "3", "4", "5", "6"], "y": ["0", "1"], "z": []}


def test_closure_takes_the_least_depth(spark):
    isa = spark.createDataFrame([("1", "2"), ("1", "3"), ("2", "4"), ("3", "4"), ("4", "1")], "parent string, child string")
    rows = terminology.closure(isa, spark.createDataFrame([("1",)], "code string"))
    assert sorted((r["code"], r["depth"]) for r in rows.collect()) == [("1", 0), ("2", 1), ("3", 1), ("4", 2)]
    assert terminology.closure(isa, spark.createDataFrame([("1",)], "code string"), depth=1).count() == 3


def test_document_failing_both_lists_counts_twice(spark):
    codes = spark.createDataFrame([("x", "d", "7"), ("x", "d", "8"), ("x", "e", "1")], "annotator string, doc string, code string")
    lists = [spark.createDataFrame(rows, "code string, fsn string") for rows in ([("1", "one")], [("7", "seven (tag)")])]
    faults = terminology.audit(codes, *lists)
    assert terminology.total_documents(faults).first()["documents"] == 2
    assert terminology.tag_frequencies(faults).first()["tag"] == "tag"


def test_list_write_refuses_an_existing_revision(spark, tmp_path):
    codes = spark.createDataFrame([("2", "b"), ("1", "a")], "code string, fsn string")
    terminology.write_list(codes, str(tmp_path), "whitelist")
    assert [r["code"] for r in terminology.read_list(spark, str(tmp_path), "whitelist").collect()] == ["1", "2"]
    with pytest.raises(Exception, match="exist"):
        terminology.write_list(codes, str(tmp_path), "whitelist")


@pytest.mark.parametrize(("value", "test", "out"), [(None, "@kind==other|none", True), ("", "@kind==other|none", True), ("Other", "@kind==other|none", True), ("fax", "@kind==other|none", False), (None, "@kind", False), ("", "@kind", True), ("x", "", True)])
def test_predicates(spark, value, test, out):
    row = spark.createDataFrame([({"kind": value},)], "features map<string,string>")
    assert row.select(mapping.predicate(test, F.col("features")).alias("x")).first()["x"] is out


def test_most_specific(spark):
    rows = spark.createDataFrame([("d", 1, "T", 0, 5, {"a": None, "b": "1"}), ("d", 2, "T", 0, 5, {"a": "1", "b": "1"}), ("d", 3, "T", 0, 5, {"a": "1", "b": "2"})], "doc string, ann_id long, type string, begin int, end int, features map<string,string>")
    assert [r["ann_id"] for r in mapping.most_specific(rows).collect()] == [2]


def test_competing_targets():
    rules = mapping.MappingRules([mapping.Rule("s", "a", "L", "", {}, "kind"), mapping.Rule("s", "b", "L", "", {}, "kind")])
    with pytest.raises(ValueError, match="compete"):
        mapping.validate(rules)


def test_type_closure_and_merge(spark):
    types = spark.createDataFrame([("C", "B"), ("B", "A"), ("A", None)], "type string, supertype string")
    assert {(r[0], r[1]) for r in mapping.type_closure(types).collect()} >= {("C", "A"), ("C", "C"), ("B", "A")}
    a = spark.createDataFrame([("T", "f", "String")], "type string, feature string, range string")
    with pytest.raises(ValueError, match="two ranges"):
        mapping.merge_types(a, a.withColumn("range", F.lit("Long")))


def test_merge_codes_drops_what_only_later_sources_have(spark):
    rows = lambda x: spark.createDataFrame(x, "anno_type string, id int, codes array<string>")
    out = lookups.merge_codes(rows([("t", 1, ["a"]), ("t", 2, [])]), [rows([("t", 1, ["b"]), ("t", 3, ["c"])])])
    assert {r["id"]: r["codes"] for r in out.collect()} == {1: ["a", "b"], 2: []}


def test_closest_code(spark):
    codes = spark.createDataFrame([("0341", "L"), ("0351", "D"), ("030", "B")], "code string, city string")
    rows = lookups.closest_code(spark.createDataFrame([("0342",), ("036",), ("03",), ("9",), ("x",)], "number string"), codes)
    assert {r["number"]: r["city"] for r in rows.collect()} == {"0342": "L", "036": "D", "03": "B"}


def test_mass_prefix_includes_the_one_that_reaches_half(spark):
    rows = spark.createDataFrame([("q", i, s) for i, s in enumerate([5.0, 3.0, 1.0, 1.0, 0.0])], "query string, item int, score double")
    assert [r["item"] for r in nearest.mass_prefix(rows, ["query"]).orderBy("item").collect()] == [0]
    assert nearest.mass_prefix(rows.where("score = 0"), ["query"], positive=True).count() == 0


def test_place_tree_keeps_shape_and_levels(spark):
    geo = spark.createDataFrame([("s1", None, "S1", 4), ("s2", None, "S2", 4), ("c1", "s1", "C1", 8), ("c2", "s2", "C2", 8), ("c3", "s2", "C3", 8)], "id string, parent_id string, name string, admin_level int")
    mentions = spark.createDataFrame([("d", "S1", 4), ("d", "C1", 8), ("d", "Nowhere", 9)], "doc string, text string, level int")
    rows = {r["text"]: r["surrogate"] for r in places.surrogates(mentions, geo, "run").collect()}
    assert rows["S1"] == "S2" and rows["C1"] in ("C2", "C3") and rows["Nowhere"].startswith("PLACE_")
