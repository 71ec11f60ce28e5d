"""Reports: small results as Markdown and JSON, and tables of predictions."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators import quality as checks

#: A report is for reading; what is larger belongs in a table.
MOST_ROWS = 100_000


def rows_of(df: DataFrame) -> list[dict]:
    rows = df.limit(MOST_ROWS + 1).collect()
    if len(rows) > MOST_ROWS:
        raise ValueError(f"a report of over {MOST_ROWS} rows; write it as a table")
    return [r.asDict(recursive=True) for r in rows]


def table(rows: list[dict], columns: list[str]) -> str:
    """A Markdown table; bars within cells are escaped."""
    cell = lambda v: "" if v is None else str(v).replace("|", r"\|").replace("\n", " ")
    lines = ["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(r.get(c)) for c in columns) + " |" for r in rows])


def quality(counts: DataFrame, verdicts: DataFrame, errors: DataFrame, key: str = "doc") -> dict[str, str]:
    """The quality report's files by name: one JSON with sorted keys, one Markdown."""
    c, v, e = (rows_of(x.orderBy(*order)) for x, order in ((counts, [key, "kind"]), (verdicts, [key]), (errors, [key, "begin"])))
    body = {"counts": c, "part_of_corpus": {str(r[key]): r["part_of_corpus"] for r in v}, "wrong_annotations": e}
    out = [r for r in v if not r["part_of_corpus"]]
    text = ["# Quality control", "", f"{len(v)} documents, {len(out)} left out.", "", "## Counts", "", table(c, [key, "kind", "n"]), "", "## Left out", "", table(out, [key]), "", "## Wrong annotations", "", table(e, [key, "kind", "begin", "end", "text"])]
    return {"quality_control.json": json.dumps(body, sort_keys=True, ensure_ascii=False, indent=1), "quality_control.md": "\n".join(text) + "\n"}


def quality_tables(spans: DataFrame, folder: str, kinds: Sequence[str], key: str = "doc") -> None:
    """The quality report as three CSV tables with a header, of any size, which Spark writes.

    ``counts``: documents by kind; ``verdicts``: which documents are part of the corpus;
    ``errors``: the spans without a kind or of kind OTHER.
    """
    tables = {"counts": checks.pivot(spans, kinds, key), "verdicts": checks.verdict(spans, key), "errors": checks.errors(spans, key)}
    for name, rows in tables.items():
        rows.write.mode("errorifexists").option("header", True).option("escape", '"').csv(f"{folder}/{name}")


def audit(faults: DataFrame) -> str:
    """The audit's Markdown: for each list and annotator a table of documents and codes, then the totals."""
    rows = rows_of(faults.select("list", "annotator", "doc", "code", "fsn").orderBy("list", "annotator", "doc", "code"))
    out = ["# Terminology audit"]
    for name in sorted({r["list"] for r in rows}):
        own = [r for r in rows if r["list"] == name]
        out += ["", f"## {name}"]
        for a in sorted({r["annotator"] for r in own}):
            mine = [r for r in own if r["annotator"] == a]
            out += ["", f"### {a}", "", f"{len({r['doc'] for r in mine})} documents, {len(mine)} codes.", "", table(mine, ["doc", "code", "fsn"])]
        if name == "whitelist":
            key, title = "code", "Most common codes"
        else:
            key, title = "tag", "Most common tags"
            own = [r | {"tag": (r["fsn"] or "").partition("(")[2].partition(")")[0]} for r in own]
        n: dict[str, int] = {}
        for r in own:
            n[r[key]] = n.get(r[key], 0) + 1
        out += ["", f"### {title}", "", table([{key: k, "n": v} for k, v in sorted(n.items(), key=lambda x: (-x[1], x[0]))], [key, "n"])]
    if not rows:
        out += ["", "No faulty documents found."]
    return "\n".join(out) + "\n"


def predictions(rows: DataFrame, feature: str, layer: str, score: bool = True) -> DataFrame:
    """Predicted spans of a layer: the label is the row's ``feature`` where it has one, else its label; without a label, none."""
    label = F.coalesce(F.try_element_at("features", F.lit(feature)), F.col("label"))
    out = rows.withColumn("_label", label).where("_label IS NOT NULL AND begin IS NOT NULL AND end IS NOT NULL")
    extra = [F.coalesce("score", F.lit(0.0)).alias(f"{feature}_score")] if score else []
    return out.select("doc", F.lit(layer).alias("type"), "begin", "end", F.col("_label").alias(feature), F.lit(True).alias("inception_internal_predicted"), *extra)


def relations(rows: DataFrame, annotations: DataFrame, layer: str) -> DataFrame:
    """Predicted relations (doc, source, target, label): the span is the target's, the governor the source's id."""
    place = annotations.select(F.col("doc").alias("_doc"), F.col("ann_id").alias("_id"), "begin", "end")
    known = annotations.select(F.col("doc").alias("_sdoc"), F.col("ann_id").alias("_sid"))
    out = rows.join(place, (rows["doc"] == place["_doc"]) & (rows["target"] == place["_id"])).join(known, (rows["doc"] == known["_sdoc"]) & (rows["source"] == known["_sid"]))
    return out.select("doc", F.lit(layer).alias("type"), "begin", "end", F.col("source").alias("governor"), F.col("target").alias("dependent"), "label", F.lit(True).alias("inception_internal_predicted"))


def payload_rows(payload: Column, layer: str | None = None) -> Column:
    """Rows of a service's JSON payload with begin, end and type; score 0 where there is none; ``layer`` keeps that type."""
    rows = F.from_json(payload, "array<struct<begin:int,end:int,type:string,score:double,features:map<string,string>>>")
    full = F.filter(rows, lambda r: r["begin"].isNotNull() & r["end"].isNotNull() & r["type"].isNotNull() & (F.lit(layer is None) | (r["type"] == (layer or ""))))
    return F.transform(full, lambda r: F.struct(r["begin"].alias("begin"), r["end"].alias("end"), r["type"].alias("type"), F.coalesce(r["score"], F.lit(0.0)).alias("score"), r["features"].alias("features")))
