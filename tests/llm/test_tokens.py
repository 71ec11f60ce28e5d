import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textloom.llm import bpe, queries, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_encode_as_the_library_does(library, odd_texts):
    mine, decoder = bpe.PrefixBpe(bpe.definition_of(PATH)), bpe.Decoder(bpe.definition_of(PATH))
    r = random.Random(1)
    letters = "aaab  e's't\x1c\x1d\u0301é中文😀ΣİΟΣ \xa0_-'ll12½²٣ßÅ\n\x85ŉﬁ"
    texts = [t or "" for t in odd_texts] + ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(r.choice("aeinrtsoh") for _ in range(60)) for _ in range(500)] + ["a" * n for n in range(120)] + ["a<|startoftext|>b <|endoftext|>"]
    for text, theirs in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = mine.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == theirs.ids, text[:80]
        assert decoder.decode(ids) == library.decode(theirs.ids, skip_special_tokens=False)


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "GENERATION", 3)
    small, large = bpe.PrefixBpe(bpe.definition_of(PATH)), bpe.loaded(bpe.definition_of(PATH))
    text = "some words, some more words; and other some"
    assert small.fresh().encode(text) == large.encode(text) == small.fresh().encode(text)


def test_operator_keeps_rows_and_columns(docs, none):
    out = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert out.columns == [*docs.columns, "ids", "decoded"] and out.count() == docs.count()
    empty = out.where("text IS NULL").first()
    assert empty["ids"] == b"" and empty["decoded"] == ""
    assert bpe.encode(none, PATH).count() == 0
    assert "text" not in bpe.encode(docs, PATH, keep=False).columns
    with pytest.raises(ValueError, match="exists"):
        bpe.encode(docs.withColumnRenamed("ident", "IDS"), PATH)


def test_round_trip_in_one_pass(docs, none):
    two = bpe.decode(bpe.encode(docs, PATH), PATH)
    one = bpe.round_trip(docs, PATH)
    assert one.columns == two.columns and sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert bpe.round_trip(none, PATH, keep=False).columns == [c for c in two.columns if c != "text"]


def test_query(spark, docs, tmp_path, library):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op2_bpe(spark, str(tmp_path)).collect()
    known = {}
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        known.setdefault(r["doc_id"], []).append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert len(rows) == docs.count()
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) in known[r["doc_id"]] for r in rows)


def greedy(vocabulary, word, mark):
    n = at = 0
    longest = max(map(len, vocabulary))
    while at < len(word):
        for end in range(min(len(word), at + longest), at, -1):
            if (word[at:end] if at == 0 else mark + word[at:end]) in vocabulary:
                break
        else:
            return 1
        n, at = n + 1, end
    return n


def test_counts_are_greedy_longest_match():
    r = random.Random(3)
    for _ in range(800):
        mark = r.choice(["", "##"])
        vocabulary = {"".join(r.choice("abc") for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 14))}
        vocabulary = {(mark if mark and r.random() < 0.6 else "") + v for v in vocabulary}
        automaton = token_counts.PieceCounter(vocabulary, mark)
        for _ in range(20):
            word = "".join(r.choice("abc") for _ in range(r.randint(0, 12)))
            assert automaton.count(word) == greedy(vocabulary, word, mark), (vocabulary, word)


def test_count_query(spark, docs, none, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op1_tokens(spark, str(tmp_path)).collect()
    pieces = {p.removesuffix("</w>") for p in bpe.strings_of({"model": {"vocab": bpe.json.loads(bpe.definition_of(PATH))["model"]["vocab"]}, "added_tokens": []}).values()}
    to = token_counts._stand_ins()
    for r in docs.collect():
        words = [w for c in (r["text"] or "").split() for w in token_counts.words_of(c)]
        want = sum(greedy(pieces, w.encode().decode("latin-1").translate(to), "") for w in words)
        assert (r["doc_id"], len(words), want) in {(x["doc_id"], x["n_words"], x["n_tokens"]) for x in rows}
    assert token_counts.token_counts(none, PATH).count() == 0
