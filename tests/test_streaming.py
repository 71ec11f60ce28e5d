from textloom.streaming import documents


def test_stream_of_documents(spark, tmp_path):
    rows = [("a", "x@y.org", "2024-01-01 00:10:00"), ("b", "x@y.org p@q.de", "2024-01-01 00:20:00"), ("c", "none", "2024-01-01 02:00:00")]
    schema = "doc string, text string, ts timestamp"
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "doc string, text string, ts string").selectExpr("doc", "text", "cast(ts AS timestamp) AS ts").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    patterns = [("mail", "[a-z]+@[a-z.]+")]
    stream = documents.arriving(spark, str(tmp_path / "in"), schema, 1)

    def ran(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name).collect()

    counts = ran(documents.windowed_counts(stream, patterns), "counts", "complete")
    assert sorted(r["n"] for r in counts) == [0, 3]
    assert len(ran(documents.keyed(stream, patterns, "s"), "keys", "append")) == 3
    spans = documents.extract(stream, patterns)
    numbered = ran(documents.run_dictionary(spans), "numbers", "append")
    assert {r["text"] for r in numbered} == {"x@y.org", "p@q.de"} and len(numbered) == 2
