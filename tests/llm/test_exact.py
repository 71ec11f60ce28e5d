import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from textloom.llm import common, exact_dedup, queries

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def expected(rows):
    low = [(r["doc_id"], (r["text"] or "").translate(str.maketrans(UPPER, LOWER))) for r in rows]
    groups = {}
    for i, t in low:
        groups.setdefault(t, []).append(i)
    return sorted((str(i), str(max((x for x in groups[t] if x is not None), default=None)), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in low)


def test_groups_as_by_brute_force(docs, none):
    rows = exact_dedup.exact_groups(docs).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in rows) == expected(docs.collect())
    kept = {}
    for r in rows:
        kept.setdefault(r["text_sha256"], []).append(r["kept"])
    assert all(sum(v) == 1 for v in kept.values())
    assert exact_dedup.exact_groups(none).count() == 0


def test_colliding_identifiers_are_told_apart(docs):
    weak = lambda c: F.pmod(F.length(c), F.lit(3))
    rows = exact_dedup.exact_groups(docs, identify=weak).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in rows) == expected(docs.collect())


def test_large_groups_are_looked_up_apart(docs, monkeypatch):
    for groups, recipes, least in ((0, 10**6, 2), (2, 0, 4), (10**5, 10**6, 2)):
        monkeypatch.setattr(exact_dedup, "LARGE_GROUPS", max(1, groups))
        monkeypatch.setattr(exact_dedup, "LARGE_RECIPES", recipes)
        monkeypatch.setattr(exact_dedup, "LEAST_LARGE", least)
        rows = exact_dedup.exact_groups(docs).collect()
        assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in rows) == expected(docs.collect())
        assert sum(r["kept"] for r in rows) == len({r["text_sha256"] for r in rows})


@pytest.mark.parametrize("most", [0, 10**6])
def test_keep_one(docs, none, monkeypatch, most):
    monkeypatch.setattr(common.without, "__defaults__", (most,))
    assert exact_dedup.keep_one(none).count() == 0
    out = exact_dedup.keep_one(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len({x[3] for x in expected(docs.collect())})
    assert rows and all(r in docs.collect() for r in rows)


def test_chunks_cover_the_text(spark):
    text = "The end of a line\nan other word and a vowel. " * 400 + "x" * 10_000 + "\r\n"
    parts = spark.createDataFrame([(text,)], "t string").select(exact_dedup.chunks(F.col("t")).alias("c")).first()["c"]
    assert "".join(parts) == text and len(parts) > 10 and max(map(len, parts)) <= 4096
    moved = spark.createDataFrame([("A new start. " + text,)], "t string").select(exact_dedup.chunks(F.col("t")).alias("c")).first()["c"]
    assert len(set(parts) & set(moved)) > 0  # borders come from the content


def test_query_against_sql(spark, docs, tmp_path):
    unique = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    unique.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    mine = queries.op7_exact(spark, str(tmp_path)).toPandas()
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    theirs = c.execute(exact_dedup.SQL).df()
    columns = sorted(mine.columns)
    assert sorted(mine[columns].itertuples(index=False, name=None)) == sorted(theirs[columns].itertuples(index=False, name=None))
