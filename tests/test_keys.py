"""Keys whose hashes are equal: as the SQL has them in the queries, made anew where they have to be unique."""

import duckdb
import pytest

from textloom.operators import pseudonyms
from textloom.plans.queries import QUERIES, SQL

#: Both pairs have equal hashes: one of two documents, one of a single document.
ROWS = [(2, "a password=5b9 b"), (6, "password=2559"), (1, "password=c37 and password=19e9"), (3, None)]


@pytest.mark.parametrize("name", ["key_assignment", "flat_keys", "keyed_placeholder", "nested_keys"])
def test_equal_hashes_as_in_sql(spark, tmp_path, name):
    spark.createDataFrame(ROWS, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    theirs = duck.execute(SQL[name]).df()
    mine = QUERIES[name](spark, str(tmp_path)).toPandas()[list(theirs.columns)]
    assert sorted(map(str, mine.itertuples(index=False, name=None))) == sorted(map(str, theirs.itertuples(index=False, name=None)))


def test_unique_keys_stay_unique(spark):
    spans = spark.createDataFrame([(2, "OTHER", "password=5b9"), (6, "OTHER", "password=2559")], "doc bigint, kind string, text string")
    keys = lambda **o: [r["surrogate"] for r in pseudonyms.assign_keys(spans, "salt", **o).orderBy("doc").collect()]
    assert keys() == ["LI8YT4", "LI8YT42"] and keys(unique=False) == ["LI8YT4", "LI8YT4"]
    shown = [r["replacement"] for r in pseudonyms.replacements(spans, "keyed", "salt", unique=False).collect()]
    assert shown == ["[** OTHER LI8YT4 **]"] * 2
