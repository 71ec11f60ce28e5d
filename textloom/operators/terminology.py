"""Terminology: closures of a concept graph, code lists, and the audit of coded documents against them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.strings import has_tag, semantic_tag
from textloom.sources.scratch import durable


def closure(isa: DataFrame, roots: DataFrame, depth: int | None = None) -> DataFrame:
    """(root, code, depth) of all concepts under the roots, each at its least depth, roots at 0.

    ``isa`` has (parent, child). A frontier is joined to its children level by level, and
    what was reached before is dropped, so several parents and cycles do no harm.
    """
    edges = isa.select(F.col("parent").alias("_p"), F.col("child").alias("_c")).distinct()
    reached = frontier = durable(roots.select(F.col(roots.columns[0]).alias("root"), F.col(roots.columns[0]).alias("code"), F.lit(0).alias("depth")).distinct())
    level = 0
    while depth is None or level < depth:
        level += 1
        step = frontier.join(edges, frontier["code"] == edges["_p"]).select("root", F.col("_c").alias("code"), F.lit(level).alias("depth")).distinct()
        frontier = durable(step.join(reached.select("root", "code"), ["root", "code"], "left_anti"))
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
        if level % 8 == 0:
            reached = durable(reached)
    return reached


def dump_codes(concepts: DataFrame, isa: DataFrame, root: str, tags: Sequence[str] | None = None, codes: Sequence[str] = (), depth: int | None = None, positive: bool = True) -> DataFrame:
    """(code, fsn) under ``root``: those with (or without) one of the tags, and all under any listed code."""
    spark = concepts.sparkSession
    under = closure(isa, spark.createDataFrame([(root,)], "code STRING"), depth).select("code")
    named = under.join(concepts.select("code", "fsn"), "code", "left")
    picked = named.where(has_tag(F.coalesce(F.col("fsn"), F.lit("")), tags, positive) | (F.col("code") == root))
    if codes:
        whole = closure(isa, spark.createDataFrame([(c,) for c in codes], "code STRING")).select("code").distinct()
        listed = named.join(whole, "code", "left_semi")
        picked = picked.unionByName(listed).distinct() if positive else picked.join(whole, "code", "left_anti")
    return picked.select("code", "fsn")


def split_filter_lines(lines: Sequence[str]) -> tuple[list[str], list[str]]:
    """Tags and codes of a list's lines; a line of digits is a code."""
    clean = [x.strip() for x in lines if x.strip()]
    return [x for x in clean if not x.isdigit()], [x for x in clean if x.isdigit()]


def write_list(codes: DataFrame, path: str, list_type: str, revision: int = 0, overwrite: bool = False) -> None:
    """Codes sorted, as one revision of a list; an existing one is an error unless ``overwrite``."""
    folder = f"{path}/list_type={list_type}/revision={revision}"
    codes.select("code", "fsn").orderBy("code").write.mode("overwrite" if overwrite else "errorifexists").parquet(folder)


def next_revision(spark: SparkSession, path: str, list_type: str) -> int:
    """The number after a list's last revision; 0 if it has none yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/list_type={list_type}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return 0
    found = [x.getPath().getName().removeprefix("revision=") for x in files.listStatus(folder)]
    return max((int(n) for n in found if n.isdigit()), default=-1) + 1


def read_list(spark: SparkSession, path: str, list_type: str, revision: int = 0) -> DataFrame:
    return spark.read.parquet(path).where((F.col("list_type") == list_type) & (F.col("revision") == revision)).select("code", "fsn")


def off_list(codes: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows whose code the list lacks."""
    return codes.join(listed.select("code").distinct(), "code", "left_anti").select(*codes.columns)


def on_list(codes: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows whose code is in the list, with its name."""
    names = listed.groupBy("code").agg(F.min("fsn").alias("fsn"))
    return codes.join(names, "code").select(*codes.columns, "fsn")


def audit(codes: DataFrame, white: DataFrame | None, black: DataFrame | None) -> DataFrame:
    """All faulty rows of both passes: list is ``whitelist`` (code not in it) or ``blacklist`` (code in it).

    ``codes`` has annotator, doc and code. A list that is None has no pass.
    """
    none = F.lit(None).cast("string")
    parts = []
    if white is not None:
        parts.append(off_list(codes, white).withColumns({"fsn": none, "list": F.lit("whitelist")}))
    if black is not None:
        parts.append(on_list(codes, black).withColumn("list", F.lit("blacklist")))
    if not parts:
        return codes.limit(0).withColumns({"fsn": none, "list": none})
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def annotator_totals(faults: DataFrame) -> DataFrame:
    """(annotator, list, documents, codes) with faults."""
    return faults.groupBy("annotator", "list").agg(F.countDistinct("doc").alias("documents"), F.count("*").alias("codes"))


def total_documents(faults: DataFrame) -> DataFrame:
    """One row: faulty documents summed over lists and annotators; one that fails both lists counts twice."""
    return annotator_totals(faults).agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"))


def code_frequencies(faults: DataFrame) -> DataFrame:
    return faults.where("list = 'whitelist'").groupBy("code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code")


def tag_frequencies(faults: DataFrame) -> DataFrame:
    return faults.where("list = 'blacklist'").groupBy(semantic_tag(F.col("fsn")).alias("tag")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tag")


def concept_dump(faults: DataFrame) -> DataFrame:
    """(code, offsets, fsn): sorted places of each code over all documents, and its name if a pass has found one."""
    place = F.struct("doc", "begin", "end")
    return faults.groupBy("code").agg(F.array_sort(F.collect_set(place)).alias("offsets"), F.max("fsn").alias("fsn"))
