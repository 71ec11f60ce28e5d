import textwrap

import pytest

from textloom.llm import license_scan


def test_wrapped_notices_are_found(spark):
    notices = [(label, f"{'filler ' * 37}{t} {'tail ' * 41}") for label, t in license_scan.TEMPLATES]
    rows = [(label, textwrap.fill(t, width, initial_indent=start, subsequent_indent=start)) for label, t in notices for width in (30, 72) for start in ("", " * ")]
    out = license_scan.scan(spark.createDataFrame(rows, "label string, text string")).collect()
    assert len(out) == len(rows) and all(r["label"] in r["licenses"]["labels"] for r in out)
    assert [r["licenses"]["score"] for r in out] == pytest.approx([1.0] * len(rows))


def test_templates_longer_than_a_block(spark):
    long = " ".join(f"w{i}" for i in range(90))
    docs = spark.createDataFrame([(textwrap.fill(f"{'filler ' * 50}{long} tail", 72),)], "text string")
    assert license_scan.scan(docs, templates=[("long", long)]).first()["licenses"]["score"] == 1.0
