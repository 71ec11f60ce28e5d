"""The algebra of spans: finding, covered text, containment, context, rewriting, shifting.

Offsets count code points, from 0, and the end is exclusive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.arrays import folds, let, running


def covered(text: Column, begin: Column, end: Column) -> Column:
    return F.substring(text, (begin + 1).cast("int"), (end - begin).cast("int"))


def matches(text: Column, pattern: str, kind: str) -> Column:
    """Array of (begin, end, kind, text) of a pattern's matches in a text, null for null.

    Places come from the lengths of what stands between the matches, as Spark's own
    functions for pattern places count UTF-16 units; the cost is in proportion to the text.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<begin:int,end:int,kind:string,text:string>>")

    def placed(pairs: Column) -> Column:
        ends = running(F.transform(pairs, lambda x: (F.length(x["g"]) + F.length(x["m"])).cast("bigint")))
        return F.zip_with(pairs, ends, lambda x, e: F.struct((e - F.length(x["m"])).cast("int").alias("begin"), e.cast("int").alias("end"), F.lit(kind).alias("kind"), x["m"].alias("text")))

    pairs = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(m.alias("m"), g.alias("g")))
    return F.when(text.rlike(pattern), let(pairs, placed)).otherwise(none)


def extract(docs: DataFrame, patterns: Sequence[tuple[str, str]], key: str = "doc", text: str = "text") -> DataFrame:
    """(key, begin, end, kind, text) of all matches of (kind, pattern) pairs; patterns may overlap each other."""
    every = F.concat(*[matches(F.col(text), p, k) for k, p in patterns])
    return docs.select(key, F.explode(every).alias("s")).select(key, "s.begin", "s.end", "s.kind", "s.text")


def contained(outer: DataFrame, inner: DataFrame, on: Sequence[str] | str, columns: tuple[str, str] = ("begin", "end")) -> DataFrame:
    """Pairs of spans of one document where the inner one lies within the outer, itself included.

    The inner side's columns get the prefix ``inner_``. The join is by the document; an
    outer span's row meets all inner ones of its document only.
    """
    keys = [on] if isinstance(on, str) else list(on)
    begin, end = columns
    renamed = inner.select(*[F.col(c).alias(f"inner_{c}") for c in inner.columns])
    same = [outer[k] == renamed[f"inner_{k}"] for k in keys]
    within = [renamed[f"inner_{begin}"] >= outer[begin], renamed[f"inner_{end}"] <= outer[end]]
    out = outer.join(renamed, [*same, *within])
    return out.drop(*[f"inner_{k}" for k in keys])


def preceding(annotations: DataFrame, tokens: DataFrame, key: str = "doc", k: int = 5) -> DataFrame:
    """Each annotation with ``before``: the texts of the last k tokens that end at or before it, in their order.

    Both sides are put in one order by place in a document, and a frame looks back from
    each annotation, so a document's tokens are not paired with its annotations.
    """
    names = [c for c in annotations.columns if c != key]
    whole = F.struct(*names)
    a = annotations.select(F.col(key).alias("_doc"), F.col("begin").alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast("string").alias("_token"), whole.alias("_row"))
    t = tokens.select(F.col(key).alias("_doc"), F.col("end").alias("_at"), F.lit(0).alias("_side"), F.col("text").alias("_token"), F.lit(None).cast(annotations.select(whole.alias("r")).schema["r"].dataType).alias("_row"))
    numbered = Window.partitionBy("_doc").orderBy("_at", "_side")
    # k tokens back are a bounded frame by the number of tokens so far
    rows = a.unionByName(t).withColumn("_n", F.sum(1 - F.col("_side")).over(numbered.rowsBetween(Window.unboundedPreceding, 0)))
    back = Window.partitionBy("_doc").orderBy("_n").rangeBetween(-(k - 1), 0)
    texts = rows.withColumn("_before", F.collect_list(F.when(F.col("_side") == 0, F.struct("_n", "_token"))).over(back)).where("_side = 1")
    before = F.transform(F.array_sort("_before"), lambda x: x["_token"])
    return texts.select(F.col("_doc").alias(key), *[F.col(f"_row.`{c}`") for c in names], before.alias("before"))


def outermost(spans: Column) -> Column:
    """Sorted by begin, longest first, without spans that begin within one kept before."""

    def kept(ordered: Column) -> Column:
        # a character for each span tells whether it stays
        def part(a: Column, values: Column) -> Column:
            zero = F.struct(a["end"].alias("end"), F.lit("").alias("marks"))
            stays = lambda s, x: x["begin"] >= s["end"]
            step = lambda s, x: F.struct(F.when(stays(s, x), x["end"].cast("bigint")).otherwise(s["end"]).alias("end"), F.concat(s["marks"], F.when(stays(s, x), "1").otherwise("0")).alias("marks"))
            return F.aggregate(values, zero, step, lambda s: F.struct(s["end"].alias("end"), F.concat(a["marks"], s["marks"]).alias("marks")))

        start = F.struct(F.lit(-(1 << 62)).cast("bigint").alias("end"), F.lit("").alias("marks"))
        marks = F.aggregate(folds(ordered), start, part, lambda a: F.split(a["marks"], ""))
        both = F.zip_with(ordered, marks, lambda x, m: F.struct(x.alias("x"), m.alias("m")))
        return F.when(F.size(ordered) > 0, F.transform(F.filter(both, lambda z: z["m"] == "1"), lambda z: z["x"])).otherwise(ordered)

    keyed = F.array_sort(F.transform(spans, lambda x: F.struct(x["begin"].cast("bigint").alias("b"), (-x["end"]).cast("bigint").alias("e"), x.alias("x"))))
    return let(F.transform(keyed, lambda k: k["x"]), kept)


def rewrite(text: Column, spans: Column) -> Column:
    """Struct of the text with every span replaced, and the spans with their new places.

    ``spans`` is an array of structs with begin, end and replacement; of overlapping ones
    the outermost counts, of equal ones the least replacement. Null or no spans leave the
    text as it is. The text is cut fold by fold, so the cost is in proportion to it.
    """
    made = "array<struct<begin:int,end:int,old_begin:int,old_end:int>>"

    def at(chosen: Column) -> Column:
        ends = F.transform(chosen, lambda x: x["end"].cast("int"))
        before = F.concat(F.array(F.lit(0)), F.slice(ends, F.lit(1), F.size(ends) - 1))
        pairs = F.zip_with(chosen, before, lambda x, p: F.struct(p.alias("from"), x["begin"].cast("int").alias("begin"), x["end"].cast("int").alias("end"), x["replacement"].alias("new")))
        return let(pairs, new)

    def new(pairs: Column) -> Column:
        def part(values: Column) -> Column:
            first = F.element_at(values, 1)["from"]
            last = F.element_at(values, -1)["end"]
            piece = lambda whole: F.array_join(F.transform(values, lambda x: F.concat(covered(whole, x["from"] - first, x["begin"] - first), x["new"])), "")
            return let(covered(text, first, last), piece)

        tail = F.element_at(pairs, -1)["end"]
        whole = F.concat(F.array_join(F.transform(folds(pairs), part), ""), covered(text, tail, F.length(text)))
        grown = running(F.transform(pairs, lambda x: (F.length(x["new"]) - (x["end"] - x["begin"])).cast("bigint")))
        places = F.zip_with(pairs, grown, lambda x, d: F.struct((x["end"] + d - F.length(x["new"])).cast("int").alias("begin"), (x["end"] + d).cast("int").alias("end"), x["begin"].alias("old_begin"), x["end"].alias("old_end")))
        return F.struct(whole.alias("text"), places.cast(made).alias("spans"))

    unchanged = F.struct(text.alias("text"), F.array().cast(made).alias("spans"))
    return F.when(F.size(F.coalesce(spans, F.slice(spans, 1, 0))) > 0, let(outermost(spans), at)).otherwise(unchanged)


def shifted(offset: Column, moved: Column) -> Column:
    """Where an offset of the old text lies in the new one: moved by the spans that end at or before it."""
    delta = lambda x: (x["end"] - x["begin"]) - (x["old_end"] - x["old_begin"])
    return offset + F.aggregate(F.filter(moved, lambda x: x["old_end"] <= offset), F.lit(0), lambda a, x: a + delta(x))


def islands(spans: DataFrame, key: str, gap: int = 1, least: int = 1, most: int = 100) -> DataFrame:
    """Runs of spans with at most ``gap`` characters between them: (key, begin, end, n) of runs of ``least`` to ``most``."""
    order = Window.partitionBy(key).orderBy("begin", "end")
    so_far = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(so_far.isNull() | (F.col("begin") - so_far > gap), 1).otherwise(0)
    runs = spans.withColumn("_new", new).withColumn("_run", F.sum("_new").over(order))
    out = runs.groupBy(key, "_run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"), F.count("*").alias("n"))
    return out.where(F.col("n").between(least, most)).drop("_run")


def beside(spans: DataFrame, others: DataFrame, key: str, gap: int = 2) -> DataFrame:
    """``spans`` next to one of ``others`` of the same document, with at most ``gap`` characters between."""
    o = others.select(F.col(key).alias("_key"), F.col("begin").alias("_begin"), F.col("end").alias("_end"))
    near = ((o["_begin"] - spans["end"]).between(0, gap)) | ((spans["begin"] - o["_end"]).between(0, gap))
    return spans.join(o, (spans[key] == o["_key"]) & near, "left_semi")
