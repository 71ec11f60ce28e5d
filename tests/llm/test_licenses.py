import random
import re
from fractions import Fraction

import pytest

from textloom.llm import license_scan, queries

PHRASES = [(["mit", "license"], "mit"), (["apache", "license"], "apache"), (["general", "public", "license"], "gpl")]


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    words = words_of(text)
    places = sorted((i, label) for p, label in PHRASES for i in range(len(words)) if words[i : i + len(p)] == p)
    return len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({x for _, x in places}))


def method(text, templates=license_scan.TEMPLATES, t=Fraction(4, 5)):
    """Labels and score from windows of 64 words (or twice the longest template) at every half."""
    labels, score = set(), 0.0
    words, half = words_of(text), max(32, *(len(words_of(x)) for _, x in templates))
    for at in range(0, max(1, len(words)), half):
        block = set(words[at : at + 2 * half])
        for label, template in templates:
            own = set(words_of(template))
            if len(own & block) >= t * len(own):
                labels.add(label)
                score = max(score, len(own & block) / len(own))
    return labels, score


CASES = [
    "MIT License", "the mit  LICENSE, mit-license; mit license", "MIT Licenses permit license", "apache\nlicense general public\x00license", "general general public license apache license",
    "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "x\nThis work is licensed under the GNU General Public License, version 2.\ny",
    "released under some license", "ÄMIT License mit licenseé mit license", "Redistribution and use in source and binary forms, with modification, are permitted provided that the following conditions are met",
    "word " * 100 + "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files " + "word " * 100,
]


@pytest.fixture(scope="module")
def cases(spark, odd_texts):
    r = random.Random(6)
    pool = sorted({w for _, t in license_scan.TEMPLATES for w in words_of(t)})
    made = ["\n".join(" ".join(r.choice(pool) for _ in range(r.randint(1, 40))) for _ in range(3)) for _ in range(120)]
    for _, t in license_scan.TEMPLATES:
        for _ in range(6):
            words = [w for w in t.split() if r.random() > 0.12]
            r.shuffle(words)
            made.append(" ".join(words))
    return spark.createDataFrame(list(enumerate([*CASES, *odd_texts, *made])), "doc_id long, text string")


def test_query_as_by_brute_force(spark, cases, tmp_path):
    cases.write.parquet(str(tmp_path / "documents.parquet"))
    texts = {r["doc_id"]: r["text"] for r in cases.collect()}
    rows = queries.op10_licenses(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        want = base(text)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want, text
        labels, score = method(text)
        assert r["labels"] == ",".join(sorted(labels | set(filter(None, want[4].split(","))))), text
        assert r["score"] == pytest.approx(score)


def test_overlapping_places_and_clashing_columns(spark):
    docs = spark.createDataFrame([("a a a", 1, 2)], "text string, low int, hits int")
    out = license_scan.scan(docs, phrases=[("a a", "twice")]).first()
    assert out["licenses"]["n_base"] == 2 and (out["low"], out["hits"]) == (1, 2) and out["licenses"]["last_word"] == 1


def test_empty_table(none):
    assert license_scan.scan(none).count() == 0


def test_a_thousand_templates(spark):
    r = random.Random(8)
    pool = [f"w{i}" for i in range(3000)]
    templates = [(f"t{i}", " ".join(r.choice(pool) for _ in range(r.randint(1, 30)))) for i in range(1000)]
    texts = [" ".join([*(r.choice(pool) for _ in range(40)), *(w for w in r.choice(templates)[1].split() if r.random() > 0.15), *(r.choice(pool) for _ in range(60))]) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate([*texts, "", None])), "doc_id int, text string")
    for x in license_scan.scan(docs, templates=templates).collect():
        labels, score = method(x["text"], templates)
        assert set(x["licenses"]["labels"]) == labels and x["licenses"]["score"] == pytest.approx(score)


def test_needed_words_are_whole_numbers(spark):
    own = [f"w{i}" for i in range(25)]
    docs = spark.createDataFrame([(n, " ".join(own[:n])) for n in (13, 14, 15)], "n int, text string")
    found = license_scan.scan(docs, templates=[("x", " ".join(own))], containment=0.56).collect()
    assert {x["n"]: bool(x["licenses"]["labels"]) for x in found} == {13: False, 14: True, 15: True}
