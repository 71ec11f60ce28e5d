import pytest

import corpus_pipeline
from tests.llm.test_shingle_join import jaccard_components


@pytest.fixture(scope="module")
def corpus(spark):
    import random

    r = random.Random(9)
    en, de = "the house and river with light of that water stone over under".split(), "der Fluss und Haus mit Licht dem Wasser Stein über unter ein".split()
    rows = [(i, " ".join(r.choice((en, de)[i % 2]) for _ in range(60)), ("en", "de")[i % 2], f"s{i % 3}", 0) for i in range(120)]
    rows += [(200 + i, rows[i][1].upper(), rows[i][2], "s0", 0) for i in range(20)] + [(300, "12 34 !!", None, "s1", 0), (301, None, None, None, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, corpus):
    docs, sizes = corpus, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, "")
        sizes.append(docs.count())
        if name != "token ids":
            assert docs.columns == corpus.columns
        if name == "language id":
            assert {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in docs.collect()} == {300, 301}
    given = [r for r in corpus.collect() if r["doc_id"] < 300]
    unique = {}
    for r in given:
        low = "".join(c.lower() if c.isascii() else c for c in r["text"])
        unique[low] = max(unique.get(low, r), r, key=lambda x: x["doc_id"])
    left = sorted(unique.values(), key=lambda r: r["doc_id"])
    groups = jaccard_components([r["doc_id"] for r in left], [r["text"] for r in left])
    assert sizes == [len(given), len(left), len(set(groups)), len(set(groups)), len(set(groups))]
    assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r, g in zip(left, groups, strict=True) if r["doc_id"] == g}


def test_run(spark, corpus, tmp_path):
    corpus.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.where("n_tokens > 0").count() == out.count() > 0


def test_empty(spark, corpus):
    docs = corpus.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
