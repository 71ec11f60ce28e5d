import zlib

import numpy as np
import pytest

from textloom.llm import language_id, queries

EN, DE = "the house and the river with this light of that water", "der Fluss und das Haus mit diesem Licht über dem Wasser"


@pytest.fixture(scope="module")
def labelled(spark):
    rows = []
    for i in range(160):
        words = (EN, DE)[i % 2].split()
        rows.append((i, " ".join(words[(i * 7 + j) % len(words)] for j in range(5 + i % 9)), ("en", "de")[i % 2], "s", "x"))
    rows += [(500, None, "en", "s", "x"), (501, "123 !", "de", "s", "x"), (502, "", None, "s", "x"), (503, EN * 400, None, "s", "x"), (503, EN * 400, None, "s", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, language_ string")


@pytest.mark.parametrize("k", [0, 1, 2, 4, 5, 9, 40])
def test_codewords_differ(k):
    code = language_id.codewords(k)
    assert len(code) == k and len({r.tobytes() for r in code}) == (k if k != 1 else 1)
    if k > 5:
        apart = (code.shape[1] - code.astype(int) @ code.T) // 2 + 99 * np.eye(k, dtype=int)
        assert apart.min() >= 3  # one wrong bit is corrected


def test_one_wrong_bit_is_corrected():
    code = language_id.codewords(9)
    model = language_id.Model([str(i) for i in range(9)], code, None, None, np.full(code.shape, 1 / code.shape[1]))
    for i, word in enumerate(code.astype(float)):
        for b in range(code.shape[1]):
            margins = 3 * word
            margins[b] = -margins[b]
            assert model.decode(margins)[0] == str(i)


def test_held_out_accuracy(spark, labelled, tmp_path):
    labelled.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op3_language(spark, str(tmp_path)).collect()
    lang = {r["doc_id"]: r["lang"] for r in labelled.collect()}
    assert len(rows) == labelled.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        if r["doc_id"] < 500:
            assert r["lang_pred"] == lang[r["doc_id"]]
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert found[500] == found[501] == found[502] == ("und", 0.0) and found[503][0] == "en"


def test_labels_of_held_out_rows_are_not_learned(spark, labelled):
    from pyspark.sql import functions as F

    wrong = labelled.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a, b = language_id.train(labelled), language_id.train(wrong)
    assert a.labels == b.labels and np.array_equal(a.weights, b.weights)


def test_without_labels(spark, labelled):
    model = language_id.train(labelled.limit(0))
    rows = language_id.identify(labelled.limit(3), model).collect()
    assert {r["language"]["lang"] for r in rows} == {"und"}
    one = language_id.train(labelled.where("lang = 'en'"))
    assert one.predict(DE)[:2] == ("en", 1.0)


def test_features_of_long_texts_go_piece_by_piece(monkeypatch):
    text = "Überall ein Haus, 12 Häuser " * 50
    whole = language_id.features(text)
    monkeypatch.setattr(language_id, "PIECE", 100)
    assert np.abs(language_id.features(text) - whole).max() < 0.05
