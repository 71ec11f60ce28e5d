"""Named queries over sources, sinks and whole runs: tables become archives, documents and reports, and are read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import pseudonyms, quality, terminology
from textloom.plans import deidentify, sql
from textloom.plans.queries import FAMILY, GIVEN, SALT, TITLES, docs, found, query, read
from textloom.sinks import reports
from textloom.sources import archive, cas
from textloom.sources.scratch import folder


def _place(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4()}"


def _files(rows: DataFrame, archive_: Column, path: Column, content: Column) -> DataFrame:
    return rows.select(archive_.alias("archive"), path.alias("path"), content.cast("binary").alias("bytes"))


def _reopened(files: DataFrame) -> DataFrame:
    return archive.opened(archive.packed(files))


@query("SELECT 'p' || (doc_id % 20) || '.zip' AS archive, 'source/' || doc_id || '.txt' AS path, md5(coalesce(text, '')) AS digest FROM documents")
def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc").cast("string")
    files = _files(docs(spark, sf_dir), F.concat(F.lit("p"), (F.col("doc") % 20).cast("string"), F.lit(".zip")), F.concat(F.lit("source/"), doc, F.lit(".txt")), F.col("text"))
    return _reopened(files).select("archive", "path", F.md5("bytes").alias("digest"))


def _projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive for each nation, with metadata that names its customers as source documents."""
    state = F.when(F.col("c_custkey") % 2 == 0, "CURATION_FINISHED").otherwise("NEW")
    c = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n"), F.struct(F.col("c_custkey").cast("string").alias("name"), state.alias("state")).alias("d"))
    lists = c.groupBy("n").agg(F.collect_list("d").alias("source_documents"))
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).join(lists, F.col("n_nationkey") == F.col("n"))
    about = F.concat(F.lit("notes of #"), F.replace(F.lower("r_name"), F.lit(" "), F.lit("# ")), F.lit("# and #all"))
    meta = F.to_json(F.struct(F.col("n_name").alias("name"), about.alias("description"), "source_documents"))
    return _reopened(_files(n, F.concat("n_name", F.lit(".zip")), F.lit(archive.METADATA), meta))


@query(
    """SELECT n_name || '.zip' AS archive, n_name AS project, string_split(lower(r_name), ' ')[1] AS first_tag, count(*) AS documents FROM nation JOIN region ON n_regionkey = r_regionkey
    JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, r_name"""
)
def archive_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = archive.projects(_projects(spark, sf_dir))
    return out.select("archive", "project", F.element_at("tags", 1).alias("first_tag"), F.size("documents").cast("long").alias("documents"))


@query(
    """SELECT n_name AS project, CASE string_split(lower(r_name), ' ')[1] WHEN 'asia' THEN 'Asien' WHEN 'europe' THEN 'Europa' ELSE string_split(lower(r_name), ' ')[1] END || ',every' AS tags
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey IN (SELECT c_nationkey FROM customer)"""
)
def tags_translated(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spark.createDataFrame([("asia", "Asien"), ("europe", "Europa"), ("all", "every")], "tag string, translation string")
    out = archive.translated(archive.projects(_projects(spark, sf_dir)), words)
    return out.select("project", F.array_join("tags", ",").alias("tags"))


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two areas for each customer: the initial one, and none, one or two of annotators by the customer's number."""
    every = [("curation", "INITIAL_CAS", 0), ("curation", "anna", 1), ("curation", "bert", 2), ("annotation", "INITIAL_CAS", 0), ("annotation", "carl", 0), ("annotation", "Dora", 1)]
    kinds = F.array(*[F.struct(F.lit(a).alias("area"), F.lit(w).alias("who"), F.lit(k).alias("least")) for a, w, k in every])
    c = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = c.select("n_name", "c_custkey", F.explode(kinds).alias("f")).where(F.col("c_custkey") % 3 >= F.col("f.least"))
    path = F.concat_ws("/", "f.area", F.col("c_custkey").cast("string"), F.concat("f.who", F.lit(".json")))
    return _reopened(_files(rows, F.concat("n_name", F.lit(".zip")), path, F.lit("{}")))


@query(
    """SELECT n_name || '.zip' AS archive, CAST(c_custkey AS VARCHAR) AS doc, CASE c_custkey % 3 WHEN 0 THEN 'INITIAL_CAS' WHEN 1 THEN 'anna' ELSE 'bert' END AS annotator
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def curated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.curated(_annotated(spark, sf_dir)).drop("bytes")


STATES = """WITH f AS (SELECT n_name || '.zip' AS archive, c_custkey, unnest(CASE
    WHEN c_custkey % 2 = 0 THEN CASE c_custkey % 3 WHEN 0 THEN ['INITIAL_CAS'] WHEN 1 THEN ['anna'] ELSE ['anna', 'bert'] END
    ELSE CASE c_custkey % 3 WHEN 0 THEN ['carl'] ELSE ['carl', 'Dora'] END END) AS annotator FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.by_state(_annotated(spark, sf_dir), archive.projects(_projects(spark, sf_dir)))


@query(f"{STATES} SELECT archive, CAST(c_custkey AS VARCHAR) AS doc, annotator FROM f")
def files_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chosen(spark, sf_dir).drop("bytes")


@query(f"{STATES} SELECT DISTINCT annotator FROM f")
def annotators_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.annotators(_chosen(spark, sf_dir))


@query(f"{STATES} SELECT archive, CAST(c_custkey AS VARCHAR) AS doc, annotator FROM f WHERE annotator IN ('anna', 'Dora')")
def files_of_annotators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.only_annotators(_chosen(spark, sf_dir), ["ANNA", "dora"]).drop("bytes")


def _documents(spark: SparkSession, sf_dir: str, form: str) -> DataFrame:
    """Every document with its spans, written in a form."""
    rows = found(spark, sf_dir)
    number = F.xxhash64("doc", "begin", "end", "kind").bitwiseAND((1 << 30) - 1)
    note = F.create_map(F.lit("note"), F.concat(F.lit('a "<'), "kind"))
    rows = rows.select("doc", "begin", "end", number.alias("ann_id"), F.lit("custom.PHI").alias("type"), "kind", note.alias("features"))
    return cas.written(cas.gathered(docs(spark, sf_dir), rows), form)


ROWS = f"""{sql.SPANS} SELECT doc, 'custom.PHI' AS type, b AS span_begin, e AS span_end, kind, txt AS text, 'a "<' || kind AS note FROM spans"""


@query(ROWS)
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _documents(spark, sf_dir, "json")
    rows = cas.text_of(cas.annotations(files, "content"), cas.documents(files, "content"))
    return rows.select("doc", "type", F.col("begin").alias("span_begin"), F.col("end").alias("span_end"), "kind", "text", F.col("features")["note"].alias("note"))


@query(ROWS)
def xmi_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = cas.xmi(_documents(spark, sf_dir, "xmi")).where("error IS NULL")
    a = known.select("doc", "text", F.explode("annotations").alias("a"))
    covered = F.substring(F.col("text"), F.col("a.begin") + 1, F.col("a.end") - F.col("a.begin"))
    return a.select("doc", "a.type", F.col("a.begin").alias("span_begin"), F.col("a.end").alias("span_end"), "a.kind", covered.alias("text"), F.col("a.features")["note"].alias("note"))


@query("SELECT doc_id AS doc, md5(coalesce(text, '')) AS digest FROM documents WHERE text <> ''")
def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cas.documents(_documents(spark, sf_dir, "json"), "content").where("text != ''").select("doc", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("SELECT 'custom.PHI' AS type, 'kind' AS feature, 'uima.cas.String' AS range")
def declared_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cas.features(_documents(spark, sf_dir, "json"), "content")


@query("SELECT trim(n_name) AS value FROM nation")
def line_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _place(spark, "lines")
    read(spark, sf_dir, "nation").select(F.explode(F.array(F.concat(F.lit("  "), "n_name"), F.lit(" "))).alias("value")).write.text(path)
    return archive.lines(spark, path)


@query("SELECT r_name AS grp, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey")
def grouped_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _place(spark, "groups")
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    lists = n.groupBy("r_name").agg(F.collect_list("n_name").alias("names"))
    lists.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("r_name", "names")))).alias("value")).write.text(path)
    return archive.grouped_names(spark, path)


@query("SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS fsn, 1 AS revision FROM part WHERE p_size > 25")
def code_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, part = _place(spark, "lists"), read(spark, sf_dir, "part")
    codes = part.select(F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("fsn"), "p_size")
    for least in (40, 25):
        terminology.write_list(codes.where(F.col("p_size") > least), path, "white", terminology.next_revision(spark, path, "white"))
    last = terminology.next_revision(spark, path, "white") - 1
    return terminology.read_list(spark, path, "white", last).withColumn("revision", F.lit(last))


# runs


@query(
    f"""SELECT doc, text FROM ({sql.rewritten("repeat('X', length(txt))")}) WHERE doc IN (
    SELECT doc FROM ({sql.SPANS} SELECT * FROM spans) GROUP BY doc HAVING count(*) FILTER (kind = 'OTHER') = 0)"""
)
def gated_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality control, then masks in the documents that pass."""
    return deidentify.run(docs(spark, sf_dir), found(spark, sf_dir), "x", SALT).documents.select("doc", "text")


@query(f"{sql.SPANS}, v AS (SELECT doc, min(CASE WHEN kind = 'OTHER' THEN 0 ELSE 1 END) AS v FROM spans GROUP BY doc) SELECT doc, CASE v WHEN 1 THEN 'taken' ELSE 'left out' END AS list FROM v")
def processed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken, out = quality.split(quality.verdict(found(spark, sf_dir)))
    return taken.withColumn("list", F.lit("taken")).unionByName(out.withColumn("list", F.lit("left out")))


@query(f"{sql.SPANS} SELECT doc, 'DATE_BIRTH' AS kind, b AS span_begin, txt AS text FROM spans WHERE kind = 'ID'")
def invalid_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    births = found(spark, sf_dir).where("kind = 'ID'").withColumn("kind", F.lit("DATE_BIRTH"))
    return quality.invalid_dates(births).select("doc", "kind", F.col("begin").alias("span_begin"), "text")


def _report(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = _place(spark, "quality")
    reports.quality_tables(found(spark, sf_dir), path, [k for k, _ in sql.PATTERNS])
    return spark.read.option("header", True).option("escape", '"').csv(f"{path}/{name}")


_COUNTS = ", ".join(f"CAST(count(*) FILTER (kind = '{k}') AS VARCHAR) AS {k}" for k, _ in sql.PATTERNS)


@query(f"{sql.SPANS} SELECT CAST(doc AS VARCHAR) AS doc, {_COUNTS} FROM spans GROUP BY doc")
def report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "counts")


@query(f"{sql.SPANS} SELECT CAST(doc AS VARCHAR) AS doc, kind, CAST(b AS VARCHAR) AS span_begin, txt AS text FROM spans WHERE kind = 'OTHER'")
def report_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "errors").select("doc", "kind", F.col("begin").alias("span_begin"), "text")


_MOBILE = ", ".join(f"'{p}'" for p in "151 152 155 156 157 159 160 162 163 170 171 172 173 174 175 176 177 178 179".split())
_AREA = "split_part(split_part(txt, '(', 2), ')', 1)"
_NUMBER = "replace(trim(split_part(txt, ')', 2)), '-', '')"
_PHONE = f"""trim(split_part(txt, '(', 1)) || list_extract([{_MOBILE}], {sql.number("'run'", _AREA)} % 19 + 1) || {sql.scramble(_NUMBER)}"""
_PARTS = r"list_filter(regexp_split_to_array(txt, '\W+'), lambda p: p <> '')"
_CHANGED = f"list_filter(({_PARTS})[:-2], lambda p: lower(p) NOT IN ('klinik', 'klinikum', 'krankenhaus'))"
_MAIL = f"replace(list_reduce({_CHANGED}, lambda a, p: replace(a, p, {sql.scramble('p')}), txt), ' ', '')"
FICTIVE = f"CASE kind WHEN 'ID' THEN {sql.scramble('txt')} WHEN 'CONTACT_PHONE' THEN {_PHONE} WHEN 'CONTACT_EMAIL' THEN {_MAIL} ELSE '[' || kind || ']' END"


@query(sql.rewritten(FICTIVE))
def fictive_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts collected by kind, surrogates by each kind's rule, and all documents rewritten with them."""
    pool = lambda x: F.array(*map(F.lit, x))
    rows = found(spark, sf_dir)
    made = pseudonyms.fictive(rows, "run", pool(GIVEN), pool(GIVEN), pool(FAMILY), TITLES)
    return deidentify.run(docs(spark, sf_dir), rows, "surrogate", SALT, gate=False, surrogates=made).documents.select("doc", "text")


@query(
    """SELECT doc, type, span_begin, span_end, value, score FROM (SELECT l_orderkey AS doc, 'custom.Code' AS type, l_linenumber AS span_begin, l_linenumber + 2 AS span_end,
    CASE l_returnflag WHEN 'R' THEN NULL WHEN 'A' THEN CAST(l_partkey AS VARCHAR) ELSE l_linestatus END AS value, CASE WHEN l_linenumber % 2 = 0 THEN '0.5' ELSE '0.0' END AS score FROM lineitem) WHERE value IS NOT NULL"""
)
def predicted_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    features = F.when(flag == "A", F.create_map(F.lit("value"), F.col("l_partkey").cast("string"))).otherwise(F.create_map().cast("map<string,string>"))
    score = F.when(F.col("l_linenumber") % 2 == 0, 0.5)
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("begin"), (F.col("l_linenumber") + 2).alias("end"), F.when(flag == "N", F.col("l_linestatus")).alias("label"), score.alias("score"), features.alias("features"))
    out = reports.predictions(lines, "value", "custom.Code")
    return out.select("doc", "type", F.col("begin").alias("span_begin"), F.col("end").alias("span_end"), "value", F.col("value_score").cast("string").alias("score"))


@query(
    """WITH l AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY l_orderkey, l_linenumber)
    SELECT a.l_orderkey AS doc, 'custom.Rel' AS type, b.l_linenumber AS span_begin, b.l_linenumber + 1 AS span_end, a.l_linenumber AS governor, b.l_linenumber AS dependent, CAST(a.l_partkey AS VARCHAR) AS label
    FROM l a JOIN l b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1"""
)
def predicted_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    doc, n = F.col("l_orderkey").alias("doc"), F.col("l_linenumber").cast("long")
    rows = lines.select(doc, n.alias("source"), (n + 1).alias("target"), F.col("l_partkey").cast("string").alias("label"))
    known = lines.select(doc, n.alias("ann_id"), F.col("l_linenumber").alias("begin"), (F.col("l_linenumber") + 1).alias("end"))
    return reports.relations(rows, known, "custom.Rel").select("doc", "type", F.col("begin").alias("span_begin"), F.col("end").alias("span_end"), "governor", "dependent", "label")


@query("SELECT c_custkey, c_nationkey AS span_begin, c_nationkey + 3 AS span_end, c_mktsegment AS segment FROM customer WHERE c_custkey % 3 <> 0")
def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    begin = F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey"))
    one = F.struct(begin.cast("int").alias("begin"), (F.col("c_nationkey") + 3).cast("int").alias("end"), F.lit("custom.A").alias("type"), F.create_map(F.lit("s"), F.col("c_mktsegment")).alias("features"))
    other = F.struct(F.lit(1).alias("begin"), F.lit(2).alias("end"), F.lit("custom.B").alias("type"), F.create_map(F.lit("s"), F.lit("x")).alias("features"))
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.explode(reports.payload_rows(F.to_json(F.array(one, other)), "custom.A")).alias("r"))
    return rows.select("c_custkey", F.col("r.begin").alias("span_begin"), F.col("r.end").alias("span_end"), F.col("r.features")["s"].alias("segment"))
