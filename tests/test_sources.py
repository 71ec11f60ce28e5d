import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from textloom.plans import extraction
from textloom.sinks import reports
from textloom.sources import archive, cas

TEXT = "Frau 😀 Müller kam."
SPANS = [{"type": "custom.PHI", "begin": 7, "end": 13, "kind": "NAME_PATIENT", "features": {"x": "a&b"}}, {"type": "custom.Other", "begin": 0, "end": 4, "kind": None, "features": {}}]


@pytest.fixture
def folder(tmp_path):
    content = cas.to_json(TEXT, SPANS)
    meta = {"name": "p", "description": "a #one note #two", "source_documents": [{"name": "d1", "state": "CURATION_FINISHED"}, {"name": "d2", "state": "NEW"}, {"name": "d3", "state": "NEW"}]}
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("x.txt", "inner")
    with zipfile.ZipFile(tmp_path / "p.v1.zip", "w") as z:
        z.writestr("exportedproject.json", json.dumps(meta))
        for path in ("curation/d1/INITIAL_CAS.json", "curation/d1/a.json", "curation/d1/b.json", "curation/d4/INITIAL_CAS.json", "annotation/d2/INITIAL_CAS.json", "annotation/d2/Ann.json"):
            z.writestr(path, content)
        z.writestr("more.zip", inner.getvalue())
    (tmp_path / "broken.zip").write_bytes(b"no zip")
    return str(tmp_path)


def test_archives(spark, folder):
    files = archive.members(spark, folder)
    assert files.count() == 8
    assert archive.members(spark, folder, ["q"]).count() == 0
    project = archive.projects(files)
    row = project.first()
    assert row["project"] == "p" and row["tags"] == ["one", "two"] and len(row["documents"]) == 3
    assert sorted((r["doc"], r["annotator"]) for r in archive.curated(files).collect()) == [("d1", "b"), ("d4", "INITIAL_CAS")]
    chosen = archive.by_state(files, project)
    assert sorted((r["doc"], r["annotator"]) for r in chosen.collect()) == [("d1", "a"), ("d1", "b"), ("d2", "Ann")]
    assert archive.only_annotators(chosen, ["ann"]).count() == 1
    assert archive.annotators(chosen).count() == 3
    words = spark.createDataFrame([("one", "eins")], "tag string, translation string")
    assert archive.translated(project, words).first()["tags"] == ["eins", "two"]


def test_json_round_trip(spark, folder):
    files = archive.curated(archive.members(spark, folder)).where("doc = 'd1'")
    assert cas.documents(files).first()["text"] == TEXT
    rows = cas.annotations(files)
    assert cas.layer(rows) == "custom.PHI"
    phi = cas.text_of(rows, cas.documents(files).select("doc", "text")).where("kind IS NOT NULL").first()
    assert phi["text"] == "Müller" and phi["features"] == {"x": "a&b"}
    assert ("custom.PHI", "uima.tcas.Annotation") in {tuple(r) for r in cas.types(files).collect()}
    assert ("custom.PHI", "kind", "uima.cas.String") in {tuple(r) for r in cas.features(files).collect()}


def test_xmi_round_trip(spark):
    docs = spark.createDataFrame([("d", TEXT, SPANS)], "doc string, text string, annotations array<struct<type: string, begin: int, end: int, kind: string, features: map<string,string>>>")
    out = cas.xmi(cas.written(docs, "xmi")).first()
    assert out["text"] == TEXT and out["error"] is None
    assert [(a["type"], a["begin"], a["end"], a["kind"]) for a in out["annotations"]] == [("custom.PHI", 7, 13, "NAME_PATIENT"), ("custom.Other", 0, 4, None)]
    bad = cas.xmi(spark.createDataFrame([("d", "<x"), ("e", None)], "doc string, content string")).collect()
    assert all(r["text"] is None and r["error"] for r in bad)


def test_reports(spark):
    faults = spark.createDataFrame([("whitelist", "x", "d", "1", None), ("blacklist", "x", "d", "2", "two (tag)")], "list string, annotator string, doc string, code string, fsn string")
    text = reports.audit(faults)
    assert "## blacklist" in text and "| tag | 1 |" in text
    assert "No faulty" in reports.audit(faults.limit(0))


def test_predictions(spark):
    rows = spark.createDataFrame([("d", 0, 1, "L", None, {"f": "own"}), ("d", 1, 2, None, 0.5, {})], "doc string, begin int, end int, label string, score double, features map<string,string>")
    out = reports.predictions(rows, "f", "layer").collect()
    assert len(out) == 1 and out[0]["f"] == "own" and out[0]["f_score"] == 0.0


def test_extraction(spark):
    docs = spark.createDataFrame([("d", "took aspirin and ibuprofen"), ("e", None)], "doc string, text string")
    found = extraction.extract(docs, "patterns", {"rules": [("drug", "aspirin|ibuprofen")]})
    known = spark.createDataFrame([("aspirin", "A1"), ("aspirin", "A2")], "text string, code string")
    assert {r["text"]: r["codes"] for r in extraction.code(found, known).collect()} == {"aspirin": ["A1", "A2"], "ibuprofen": []}
    assert {r["text"]: r["codes"] for r in extraction.code(found, known, first_only=True).collect()}["aspirin"] == ["A1"]


def test_structured(spark):
    spec = {"type": "object", "properties": {"n": {"type": "integer", "default": 3}, "l": {"type": "array", "items": {"type": "string"}}}}
    rows = extraction.structured(spark.createDataFrame([('{"l": ["a"]}',), ("no",)], "answer string"), spec).collect()
    assert rows[0]["answer"]["n"] == 3 and rows[0]["answer"]["l"] == ["a"]
    with pytest.raises(ValueError, match="no value"):
        extraction.template("{a} {b}", a="1")


def test_lines(spark, tmp_path):
    (tmp_path / "l.txt").write_text(" a \n\nb\n")
    assert [r[0] for r in archive.lines(spark, str(tmp_path / "l.txt")).collect()] == ["a", "b"]
    (tmp_path / "n.json").write_text('{"A": ["Anna", "Alma"]}')
    assert archive.grouped_names(spark, str(tmp_path / "n.json")).where(F.col("grp") == "A").count() == 2
