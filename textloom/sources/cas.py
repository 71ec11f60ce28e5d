"""Annotated documents as JSON or XMI: reading to rows, and writing."""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from xml.sax.saxutils import quoteattr

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SOFA = "uima.cas.Sofa"
XMI = "{http://www.omg.org/XMI}"
STRUCTURES = "struct<`%TYPES`: map<string,map<string,string>>, `%FEATURE_STRUCTURES`: array<map<string,string>>>"
#: Keys of a JSON record that aren't features.
NOT_FEATURES = ("%ID", "%TYPE", "@sofa", "begin", "end", "kind")


def parsed(content: Column) -> Column:
    """The JSON document as a struct of types and records, all values as strings; null if it is none."""
    return F.from_json(content.cast("string"), STRUCTURES)


def sofa_text(records: Column) -> Column:
    texts = F.filter(records, lambda r: r["%TYPE"] == SOFA)
    return F.try_element_at(F.try_element_at(texts, F.lit(1)), F.lit("sofaString"))


def documents(files: DataFrame, content: str = "bytes") -> DataFrame:
    """``files`` with ``text`` in place of the content; files that don't parse or have no text are dropped."""
    rows = files.withColumn("text", sofa_text(parsed(F.col(content))["%FEATURE_STRUCTURES"])).where("text IS NOT NULL")
    return rows.drop(content)


def annotations(files: DataFrame, content: str = "bytes") -> DataFrame:
    """``files`` with a row for each record that has a place: ann_id, type, begin, end, kind, features."""
    r = F.col("_r")
    rows = files.withColumn("_r", F.explode(parsed(F.col(content))["%FEATURE_STRUCTURES"])).where(r["begin"].isNotNull() & r["end"].isNotNull())
    features = F.map_filter(r, lambda k, _: ~k.isin(*NOT_FEATURES))
    number = lambda c: r[c].cast("int").alias(c)
    return rows.select(*[c for c in files.columns if c != content], r["%ID"].cast("bigint").alias("ann_id"), r["%TYPE"].alias("type"), number("begin"), number("end"), r["kind"].alias("kind"), features.alias("features"))


def types(files: DataFrame, content: str = "bytes") -> DataFrame:
    """(type, supertype) over all files."""
    t = files.select(F.explode(parsed(F.col(content))["%TYPES"]).alias("type", "d"))
    return t.select("type", F.col("d")["%SUPER_TYPE"].alias("supertype")).distinct()


def features(files: DataFrame, content: str = "bytes") -> DataFrame:
    """(type, feature, range) over all files."""
    t = files.select(F.explode(parsed(F.col(content))["%TYPES"]).alias("type", "d")).select("type", F.explode("d").alias("feature", "f"))
    return t.where(~F.col("feature").startswith("%")).select("type", "feature", F.get_json_object("f", "$['%RANGE']").alias("range")).distinct()


def layer(rows: DataFrame, part: str = "PHI") -> str | None:
    """The least type whose name has ``part``."""
    return rows.where(F.col("type").contains(part)).agg(F.min("type")).first()[0]


def text_of(rows: DataFrame, texts: DataFrame, key: str = "doc") -> DataFrame:
    """Annotations with ``text``, what they cover."""
    t = texts.select(F.col(key).alias("_key"), F.col("text").alias("_text"))
    covered = F.substring(F.col("_text"), F.col("begin") + 1, F.col("end") - F.col("begin"))
    return rows.join(t, rows[key] == t["_key"]).withColumn("text", covered).drop("_key", "_text")


def code_points(text: str, offset: int) -> int:
    """A UTF-16 offset, as Java counts, in code points."""
    return len(text.encode("utf-16-le")[: 2 * offset].decode("utf-16-le", "ignore"))


def _xmi(content: bytes) -> tuple[str, list[dict]]:
    root = ET.fromstring(content)
    texts = [e.get("sofaString", "") for e in root if e.tag.rpartition("}")[2] == "Sofa"]
    text = texts[0] if texts else ""
    wide = any(ord(c) > 0xFFFF for c in text)
    out = []
    for e in root:
        if e.get("begin") is None or e.get("end") is None:
            continue
        space, _, name = e.tag[1:].rpartition("}")
        package = space.removeprefix("http:///").removesuffix(".ecore").replace("/", ".")
        begin, end = int(e.get("begin")), int(e.get("end"))
        if wide:
            begin, end = code_points(text, begin), code_points(text, end)
        kept = {k: v for k, v in e.attrib.items() if k not in ("begin", "end", "kind", "sofa", XMI + "id")}
        out.append({"ann_id": int(e.get(XMI + "id", "0")), "type": f"{package}.{name}", "begin": begin, "end": end, "kind": e.get("kind"), "features": list(kept.items())})
    return text, out


_SPAN = pa.struct([("ann_id", pa.int64()), ("type", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("features", pa.map_(pa.string(), pa.string()))])
_SPAN_DDL = "struct<ann_id: bigint, type: string, begin: int, end: int, kind: string, features: map<string,string>>"


def xmi(files: DataFrame, key: str = "doc", content: str = "content") -> DataFrame:
    """(key, text, annotations, error) of XMI documents; those that don't parse have null text and an error.

    Places are in code points; XMI itself counts UTF-16 units.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans, errors = [], [], []
            for v in batch.column(1).to_pylist():
                try:
                    text, found = _xmi(v if isinstance(v, bytes) else (v or "").encode())
                    error = None
                except (ET.ParseError, ValueError) as x:
                    text, found, error = None, [], str(x)
                texts.append(text)
                spans.append(found)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(spans, pa.list_(_SPAN)), pa.array(errors, pa.string())], [key, "text", "annotations", "error"])

    slim = files.select(key, content)
    return slim.mapInArrow(run, f"{key} {dict(slim.dtypes)[key]}, text string, annotations array<{_SPAN_DDL}>, error string")


def to_json(text: str, spans: list[dict], types_: dict[str, dict[str, str]] | None = None) -> str:
    """A document and its spans as JSON: the text holder has the first id."""
    records = [{"%ID": 1, "%TYPE": SOFA, "sofaNum": 1, "sofaID": "_InitialView", "mimeType": "text", "sofaString": text}]
    for i, s in enumerate(spans, 2):
        extra = dict(s.get("features") or {})
        records.append({"%ID": i, "%TYPE": s["type"], "@sofa": 1, "begin": s["begin"], "end": s["end"], **({"kind": s["kind"]} if s.get("kind") is not None else {}), **extra})
    named = {s["type"] for s in spans} | set(types_ or {})
    declared = {t: {"%NAME": t, "%SUPER_TYPE": "uima.tcas.Annotation"} | {f: {"%NAME": f, "%RANGE": r} for f, r in (types_ or {}).get(t, {"kind": "uima.cas.String"}).items()} for t in sorted(named)}
    return json.dumps({"%TYPES": declared, "%FEATURE_STRUCTURES": records, "%VIEWS": {"_InitialView": {"%SOFA": 1, "%MEMBERS": list(range(2, len(spans) + 2))}}}, ensure_ascii=False)


def to_xmi(text: str, spans: list[dict]) -> str:
    """A document and its spans as XMI, with places in UTF-16 units."""
    units = lambda n: len(text[:n].encode("utf-16-le")) // 2
    packages = sorted({s["type"].rpartition(".")[0] for s in spans})
    prefix = {p: f"ns{i}" for i, p in enumerate(packages)}
    spaces = "".join(f' xmlns:{prefix[p]}="http:///{p.replace(".", "/")}.ecore"' for p in packages)
    body = []
    for i, s in enumerate(spans, 2):
        package, _, name = s["type"].rpartition(".")
        extra = {**({"kind": s["kind"]} if s.get("kind") is not None else {}), **dict(s.get("features") or {})}
        attributes = "".join(f" {k}={quoteattr(v)}" for k, v in extra.items() if v is not None)
        body.append(f'<{prefix[package]}:{name} xmi:id="{i}" sofa="1" begin="{units(s["begin"])}" end="{units(s["end"])}"{attributes}/>')
    quoted = quoteattr(text, {"\n": "&#10;", "\r": "&#13;", "\t": "&#9;"})
    members = " ".join(str(i) for i in range(2, len(spans) + 2))
    return f'<?xml version="1.0" encoding="UTF-8"?><xmi:XMI xmlns:xmi="http://www.omg.org/XMI" xmlns:cas="http:///uima/cas.ecore"{spaces} xmi:version="2.0"><cas:NULL xmi:id="0"/>{"".join(body)}<cas:Sofa xmi:id="1" sofaNum="1" sofaID="_InitialView" mimeType="text" sofaString={quoted}/><cas:View sofa="1" members="{members}"/></xmi:XMI>'


def written(docs: DataFrame, form: str = "json", key: str = "doc") -> DataFrame:
    """(key, content) of documents with text and an array of annotations, as JSON or XMI."""
    make = {"json": to_json, "xmi": to_xmi}[form]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [make(t or "", s or []) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], [key, "content"])

    slim = docs.select(key, "text", "annotations")
    return slim.mapInArrow(run, f"{key} {dict(slim.dtypes)[key]}, content string")


def gathered(texts: DataFrame, rows: DataFrame, key: str = "doc") -> DataFrame:
    """Documents with their annotations in an array, sorted by place."""
    one = F.struct("begin", "end", "ann_id", "type", "kind", "features")
    lists = rows.groupBy(F.col(key).alias("_key")).agg(F.collect_list(one).alias("_all"))
    in_order = F.array_sort("_all", lambda a, b: F.when(a["begin"] != b["begin"], a["begin"] - b["begin"]).when(a["end"] != b["end"], b["end"] - a["end"]).otherwise((a["ann_id"] - b["ann_id"]).cast("int")))
    return texts.join(lists, texts[key] == lists["_key"], "left").withColumn("annotations", in_order).drop("_key", "_all")
