from textloom.llm import pii


def test_a_secret_needs_no_digit(spark):
    texts = [("see password=abcdefghij now",), ("see password: abcdefghij now",), ("password=abcdefghij 7",), ("no secret here",)]
    docs = spark.createDataFrame(texts, "text string")
    pattern = next(p for p in pii.MORE if p[0] == "secret" and not p[2])
    rows = docs.select(pii.found(docs["text"], *pattern).alias("x")).collect()
    assert [[x["text"] for x in r["x"]] for r in rows] == [["password=abcdefghij"], ["password: abcdefghij"], ["password=abcdefghij"], []]
