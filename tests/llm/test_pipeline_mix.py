import random

import corpus_pipeline
from tests.llm.test_mixing import places
from textloom.llm import mixing


def test_run_tells_the_place_in_the_mix(spark, tmp_path):
    r, words = random.Random(3), [f"{a}{b}" for a in "the and with that house river light water stone over under".split() for b in ("", "s", "er", "ing")]
    docs = [(i, " ".join(r.choice(words) for _ in range(40)), "en", ("a", "b", "c")[0 if i % 2 else 1 + i % 3 // 2], 0) for i in range(900)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = places([(x["doc_id"], x["source"]) for x in rows], mixing.BLOCK)
    assert len(rows) > 800 and len({x["source"] for x in rows}) == 3
    assert {x["doc_id"]: (x["block"], x["slot"], x["position"]) for x in rows} == want
