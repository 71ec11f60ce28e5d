import random

import pytest

WORDS = "the of and erin thnt tion blend house river stone green water fire light over under sky lamp".split()


@pytest.fixture(scope="session")
def rng():
    return random.Random(5)


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, one letter, no letter, odd characters, very long."""
    return [None, "", "  \n\t ", "a", "123 !!", "😀 ÄÖ\u0301 ß\x1c\u0085x", "Straße 'll <|endoftext|> 12", "word " * 30_000, "x" * 50_000, "A\x00b"]


@pytest.fixture(scope="session")
def docs(spark, odd_texts, rng):
    """Documents with odd texts, copies, near copies, a null and a repeated key, and columns named like the operators' own."""
    texts = list(odd_texts)
    for _ in range(40):
        texts.append(" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 120))))
    texts += [texts[12].upper(), texts[12], texts[13] + " lamp", "Tail mail a.b@c.de"]
    rows = [(i, t, ("en", "de", None)[i % 3], f"src{min(i % 5, 2)}" if i % 7 else None, "x", 1) for i, t in enumerate(texts)]
    rows += [rows[15], rows[15], (None, "null key", "en", "src0", "y", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, ident string, `row` int")


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
