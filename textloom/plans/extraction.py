"""Extraction and coding: plug-in classifiers over documents, coded by dictionaries, each step kept."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators.lookups import enrich

#: (text) to a list of (anno_type, text)
Extractor = Callable[[str], list[tuple[str, str]]]
REGISTRY: dict[str, Callable[..., Extractor]] = {}
SHORTEST_LITERAL = 75


def register(name: str):
    def add(make: Callable[..., Extractor]) -> Callable[..., Extractor]:
        REGISTRY[name] = make
        return make

    return add


def resolve(name: str, **options) -> Extractor:
    """A registered extractor by name, or one by its dotted path."""
    if name not in REGISTRY and "." in name:
        module, _, attribute = name.rpartition(".")
        return getattr(importlib.import_module(module), attribute)(**options)
    return REGISTRY[name](**options)


@register("patterns")
def patterns(rules: Sequence[tuple[str, str]] = ()) -> Extractor:
    """A stand-in for a language model: (anno_type, pattern) pairs."""
    import re

    compiled = [(k, re.compile(p)) for k, p in rules]
    return lambda text: [(k, m[0]) for k, p in compiled for m in p.finditer(text)]


def source(spark: SparkSession, value: str, force_text: bool = False) -> DataFrame:
    """(doc, text) of a text itself, a file or a folder: short values are paths unless ``force_text``."""
    if force_text or len(value) >= SHORTEST_LITERAL:
        return spark.createDataFrame([("text", value)], "doc string, text string")
    return spark.read.option("wholetext", "true").text(value).select(F.col("_metadata.file_name").alias("doc"), F.col("value").alias("text"))


def extract(docs: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """(doc, anno_type, id, text, error): what the extractor finds in each document; an error is a row of its own.

    The id is a hash of document, type and number, so a repeated run gives the same.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work = resolve(name, **(options or {}))
        for frame in frames:
            out = []
            for doc, text in zip(frame["doc"], frame["text"], strict=True):
                try:
                    out += [(doc, n, k, t, None) for n, (k, t) in enumerate(work(text or ""))]
                except Exception as x:  # one document never ends a run
                    out.append((doc, 0, None, None, str(x)))
            yield pd.DataFrame(out, columns=["doc", "n", "anno_type", "text", "error"])

    slim = docs.select(F.col("doc").cast("string").alias("doc"), "text")
    found = slim.mapInPandas(run, "doc string, n int, anno_type string, text string, error string")
    return found.select("doc", "anno_type", F.md5(F.concat_ws("|", "doc", "anno_type", F.col("n").cast("string")).cast("binary")).alias("id"), "text", "error")


def code(found: DataFrame, dictionary: DataFrame, first_only: bool = False) -> DataFrame:
    """Extractions without errors, with ``codes`` of the dictionary (text, code)."""
    return enrich(found.where("error IS NULL").drop("error"), dictionary, "text", first_only)


def schema_of(spec: dict) -> T.DataType:
    """The type of a JSON schema: objects are structs, or maps of strings without properties; unknown types are strings."""
    kind = spec.get("type", "string")
    if isinstance(kind, list):
        kind = next((k for k in kind if k != "null"), "string")
    if kind == "array":
        return T.ArrayType(schema_of(spec.get("items", {})))
    if kind == "object":
        properties = spec.get("properties")
        if not properties:
            return T.MapType(T.StringType(), T.StringType())
        return T.StructType([T.StructField(k, schema_of(v), True) for k, v in properties.items()])
    return {"integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType()}.get(kind, T.StringType())


def structured(answers: DataFrame, spec: dict, column: str = "answer") -> DataFrame:
    """``column`` of JSON text as the schema's struct; missing parts take their default, what doesn't parse is null."""
    kind = schema_of(spec)
    out = answers.withColumn(column, F.from_json(column, kind))
    for name, part in spec.get("properties", {}).items():
        if "default" in part:
            out = out.withColumn(column, F.when(F.col(column).isNotNull(), F.col(column).withField(name, F.coalesce(F.col(column)[name], F.lit(part["default"])))))
    return out


def template(text: str, **values: str) -> str:
    """``text`` with its ``{name}`` places filled; values without place are left out, a place without value is an error."""
    import string

    names = {n for _, n, _, _ in string.Formatter().parse(text) if n}
    if missing := names - set(values):
        raise ValueError(f"no value for {sorted(missing)}")
    return text.format(**{n: values[n] for n in names})
