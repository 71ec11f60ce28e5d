"""The blocked search gives what a comparison of every pair gives."""

import os
import time

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from textloom.operators import nearest, similarity
from textloom.plans.queries import QUERIES, SQL


def table(spark, rows):
    return spark.createDataFrame(rows, "item bigint, vector array<float>")


@pytest.mark.parametrize("name", ["knn_topk", "adaptive_k", "mass_prefix", "sampling_dist", "weighted_choice", "candidate_filter"])
def test_many_copies_as_in_sql(spark, tmp_path, name):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 8)).astype("float32")
    rows = [(i, base[i % 300].tolist() if i % 3 else base[7].tolist(), i % 10) for i in range(1500)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(7).write.parquet(f"{tmp_path}/embeddings.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    theirs = duck.execute(SQL[name]).df()
    out = QUERIES[name](spark, str(tmp_path))
    assert "NestedLoop" not in out._jdf.queryExecution().toString() and "Cartesian" not in out._jdf.queryExecution().toString()
    mine = out.toPandas()[list(theirs.columns)]
    assert sorted(map(repr, mine.astype(float).values.tolist())) == sorted(map(repr, theirs.astype(float).values.tolist()))


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0]), (7, [-1.0, 0.0]), (8, [2.0, 0.0]), (None, [1.0, 1.0]), (9, [])]
    items = table(spark, rows)
    asked = items.where("item IN (1, 2, 6)").selectExpr("item AS query", "vector")
    found = {}
    for r in nearest.top_k(asked, items, 10).orderBy("query", "rank").collect():
        found.setdefault(r["query"], []).append((r["item"], None if r["similarity"] is None else str(r["similarity"])))
    empty = [(2, None), (3, None), (4, None), (6, None), (9, None)]
    assert found[1] == [(5, "nan"), (1, "1.0"), (8, "1.0"), (None, "0.707107"), (7, "-1.0"), *empty]
    assert found[2] == [(5, "nan"), (None, None), *[(i, None) for i in (1, 2, 3, 4, 6, 7, 8, 9)]]
    assert found[6] == [(6, "1.0"), (None, None), *[(i, None) for i in (1, 2, 3, 4, 5, 7, 8, 9)]]
    assert [r["item"] for r in nearest.top_k(asked.where("query = 6"), items, 3).orderBy("rank").collect()] == [6, None, 1]


def test_more_queries_than_a_block(spark):
    rng = np.random.default_rng(2)
    items = table(spark, [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 4)).astype("float32"))])
    asked = items.selectExpr("item AS query", "vector")
    one, many = (sorted(map(tuple, nearest.top_k(asked, items, 5, block=b).collect())) for b in (1000, 30))
    assert one == many and len(one) == 1000
    assert nearest.top_k(asked.where("query < 0"), items, 5).count() == 0
    named = items.selectExpr("concat('n', item) AS item", "vector")
    assert {r["item"] for r in nearest.top_k(asked.where("query = 3"), named, 1).collect()} == {"n3"}


@pytest.mark.parametrize("name", ["sampling_dist", "weighted_choice", "candidate_filter", "mass_prefix"])
def test_one_row_group_goes_to_all_cores(spark, tmp_path, monkeypatch, name):
    rng = np.random.default_rng(3)
    rows = pa.table({"vec_id": pa.array(range(9000), pa.int64()), "embedding": pa.array(rng.normal(size=(9000, 4)).tolist(), pa.list_(pa.float32())), "label": pa.array([i % 10 for i in range(9000)], pa.int32())})
    pq.write_table(rows, tmp_path / "embeddings.parquet")
    (seen := tmp_path / "seen").mkdir()
    search = nearest.nearest

    def noted(count, queries, k):
        run = search(count, queries, k)

        def noting(batches):
            met = [b for b in batches if b.num_rows]
            if met:
                (seen / f"{id(met)}-{os.getpid()}-{time.time_ns()}").write_text(str(sum(b.num_rows for b in met)))
            yield from run(iter(met))

        return noting

    monkeypatch.setattr(nearest, "nearest", noted)
    mine = QUERIES[name](spark, str(tmp_path)).toPandas()
    parts = [int(p.read_text()) for p in seen.iterdir()]
    assert sum(parts) == 9000 and max(parts) <= 2 * 9000 / spark.sparkContext.defaultParallelism
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    theirs = duck.execute(SQL[name]).df()
    assert sorted(map(repr, mine[list(theirs.columns)].astype(float).values.tolist())) == sorted(map(repr, theirs.astype(float).values.tolist()))


@pytest.mark.parametrize("k", [1, 10, 100, 700])
def test_tiles_lose_none(k):
    """Items in the order of their similarity, copies, vectors of zeros and such that hold no number, over several tiles."""
    rng = np.random.default_rng(4)
    items = rng.normal(size=(5000, 8)).astype("float32")
    asked = np.concatenate([items[:300], np.zeros((1, 8), "float32"), np.full((1, 8), np.inf, "float32")])
    items = items[np.argsort(items @ items[0])]
    items[1000:1400], items[2000], items[2001, 3], items[4999] = items[4000], 0, np.nan, np.inf
    column = lambda m: pa.array(m.tolist(), pa.list_(pa.float32()))
    names = pa.array(range(len(asked)), pa.int64())
    batches = [pa.record_batch([pa.array(range(s, s + 2500), pa.int64()), column(items[s : s + 2500])], ["item", "vector"]) for s in (0, 2500)]
    found = pa.Table.from_batches(similarity.nearest(len(names), lambda: (names, similarity.vectors(column(asked))), k)(iter(batches)))
    got = {}
    for q, i in zip(found["query"].to_pylist(), found["item"].to_pylist(), strict=True):
        got.setdefault(q, []).append(i)
    a, b = similarity.Block(np.arange(len(asked)), asked.astype(float)), similarity.Block(np.arange(5000), items.astype(float))
    for q in [*range(0, 300, 7), 300, 301]:
        order = similarity.exact(a, b, np.full(5000, q), np.arange(5000))
        assert sorted(got[q]) == sorted(np.lexsort((np.arange(5000), -order))[:k].tolist())


def test_two_cores_and_several_blocks_are_dealt_out_too(spark, tmp_path):
    rng = np.random.default_rng(6)
    pq.write_table(pa.table({"item": pa.array(range(6000), pa.int64()), "vector": pa.array(rng.normal(size=(6000, 4)).tolist(), pa.list_(pa.float32()))}), tmp_path / "items.parquet")
    items = spark.read.parquet(str(tmp_path / "items.parquet"))
    parts, even = nearest.dealt(items, 2)
    assert not even and max(parts.groupBy(F.spark_partition_id()).count().toPandas()["count"]) <= 3100
    asked = items.where("item % 20 = 0").selectExpr("item AS query", "vector")
    one, many = (sorted(map(tuple, nearest.top_k(asked, items, 5, block=b).collect())) for b in (1000, 100))
    assert one == many and len(one) == 1500


@pytest.mark.parametrize("gathered", [500, 1 << 16])
def test_copies_are_searched_once(monkeypatch, gathered):
    """As in weighted_choice over a table of copies with shifted keys: no pair is lost, but few are compared."""
    rng = np.random.default_rng(7)
    base = rng.normal(size=(300, 8)).astype("float32")
    base[5], base[6, 2] = 0, np.nan
    items = np.tile(base, (20, 1))
    ids = rng.permutation(len(items))
    column = lambda m: pa.array(m.tolist(), pa.list_(pa.float32()))
    pairs = []
    likely = similarity.likely
    monkeypatch.setattr(similarity, "GATHERED", gathered, raising=False)
    monkeypatch.setattr(similarity, "likely", lambda q, i, *rest: pairs.append(len(q.at) * len(i.at)) or likely(q, i, *rest))
    asked = np.flatnonzero(np.arange(len(items)) % 20 == 0)
    names = pa.array(asked, pa.int64())
    batches = [pa.record_batch([pa.array(ids[s : s + 1000], pa.int64()), column(items[s : s + 1000])], ["item", "vector"]) for s in range(0, len(items), 1000)]
    found = pa.Table.from_batches(similarity.nearest(len(names), lambda: (names, similarity.vectors(column(items[asked]))), 10)(iter(batches)))
    a = similarity.Block(np.arange(len(items)), items.astype(float))
    got = {}
    for q, i in zip(found["query"].to_pylist(), found["item"].to_pylist(), strict=True):
        got.setdefault(q, []).append(i)
    assert sorted(got) == asked.tolist()
    for q in asked.tolist():
        order = similarity.exact(a, a, np.full(len(items), q), np.arange(len(items)))
        assert sorted(got[q]) == sorted(ids[np.lexsort((ids, -order))[:10]].tolist())
    assert sum(pairs) <= len(np.unique(asked % 300)) * (300 * 10 if gathered > len(items) else len(items)) < len(asked) * len(items) / 15


def test_items_are_read_once_for_as_many_queries_as_fit(spark, monkeypatch):
    """As in candidate_filter, which asks for 20 neighbours: 20,500 queries are one block."""
    asked = spark.range(20_500).selectExpr("id AS query", "array(float(cos(id)), float(sin(id))) AS vector")
    items = spark.range(60).selectExpr("id AS item", "array(float(cos(id)), float(sin(id))) AS vector")
    search, calls = nearest.nearest, []
    monkeypatch.setattr(nearest, "nearest", lambda count, *rest: calls.append(count) or search(count, *rest))
    found = nearest.top_k(asked, items, 20)
    assert found.groupBy("rank").count().collect() and {r["count"] for r in found.groupBy("rank").count().collect()} == {20_500}
    assert calls == [20_500]
    assert {r["query"] for r in found.where("rank = 1 AND query < 60 AND query = item").collect()} == set(range(60))
