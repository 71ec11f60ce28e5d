import random

import numpy as np
import pytest
import xxhash

from tests.llm.test_shingle_join import jaccard_components
from textloom.llm import common, components, queries, simhash, tiles


def brute_fingerprint(text, k=3):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius=3):
    left, out = set(range(len(ids))), {}
    while left:
        todo, group = [left.pop()], []
        while todo:
            i = todo.pop()
            group.append(i)
            near = {j for j in left if bin(prints[i] ^ prints[j]).count("1") <= radius}
            left -= near
            todo += near
        least = min((ids[i] for i in group if ids[i] is not None), default=None)
        out |= {i: least for i in group}
    return [out[i] for i in range(len(ids))]


def test_fingerprints(odd_texts, rng):
    for t in [*odd_texts, "one", "one two", "a b c a b c", "Ä B\x0bC d"]:
        assert simhash.fingerprint(t) == brute_fingerprint(t), (t or "")[:40]


def test_long_texts_go_slice_by_slice(monkeypatch):
    text = " ".join(str(i % 97) for i in range(900))
    whole = simhash.fingerprint(text, 5)
    monkeypatch.setattr(simhash, "SLICE", 50)
    assert simhash.fingerprint(text, 5) == whole
    h = np.random.default_rng(3).integers(0, 2**64 - 1, 900, dtype=np.uint64)
    assert tiles.majority(h).tolist() == tiles.majority(h, most=50).tolist() and len(set(tiles.majority(h).tolist())) == 4
    assert int(tiles.majority(h, 64)[0]) == sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize(("tile", "part"), [(512, 4096), (4, 4096), (4, 6)])
def test_links_are_whole(spark, monkeypatch, tile, part):
    monkeypatch.setattr(tiles, "TILE", tile)
    monkeypatch.setattr(tiles, "PART", part)
    r = random.Random(tile + part)
    values = set()
    for _ in range(40):
        seed = r.getrandbits(64)
        for _ in range(r.choice((1, 2, 12))):
            v = seed
            for b in r.sample(range(64), r.randint(0, 5)):
                v ^= 1 << b
            values.add(v)
    values |= {1 << b for b in range(12)} | {0}  # a dense group
    values = sorted(values)
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    roots = {row["node"]: row["root"] for row in components.components(simhash.near_links(frame)).collect()}
    found = [roots.get(v, v) for v in signed]
    want = brute_components(signed, values)
    assert len(set(zip(found, want, strict=True))) == len(set(found)) == len(set(want))


def test_masks_leave_no_pair_out():
    r = random.Random(4)
    for distinct in (10, 1 << 25, 1 << 34):
        masks = simhash.masks(distinct, 3)
        for _ in range(300):
            bits = sum(1 << b for b in r.sample(range(64), 3))
            assert any(not m & bits for m in masks)


def test_query(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op9_simhash(spark, str(tmp_path)).collect()
    given = docs.collect()
    prints = [brute_fingerprint(r["text"]) for r in given]
    want = sorted((str(r["doc_id"]), f"{p:016x}", str(c)) for r, p, c in zip(given, prints, brute_components([r["doc_id"] for r in given], prints), strict=True))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in rows) == want


@pytest.mark.parametrize("most", [0, 10**6])
def test_keep_one(docs, none, monkeypatch, most):
    monkeypatch.setattr(common.without, "__defaults__", (most,))
    out = simhash.keep_one(docs)
    given = docs.collect()
    groups = jaccard_components([r["doc_id"] for r in given], [r["text"] for r in given])
    assert out.columns == docs.columns and out.count() == len(set(groups))
    assert simhash.keep_one(none).count() == 0


def test_near_copies_are_found_and_others_left(spark):
    r, pool = random.Random(8), [f"w{i}" for i in range(3000)]
    rows, copies = [], 0
    for i in range(120):
        words = [r.choice(pool) for _ in range(r.choice((90, 300)))]
        rows.append((10 * i, " ".join(words)))
        for k in range(i % 3):
            changed = list(words)
            for at in r.sample(range(len(words)), len(words) // 90):  # a similarity of about 0.9
                changed[at] = "other"
            rows.append((10 * i + k + 1, " ".join(changed)))
            copies += 1
    out = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = {x["doc_id"] for x in out.collect()}
    assert {10 * i for i in range(120)} <= kept and len(kept) <= 120 + copies // 50


@pytest.mark.parametrize(("tile", "part"), [(512, 4096), (8, 4096), (8, 40)])
def test_a_dense_group_is_one_component(spark, monkeypatch, tile, part):
    monkeypatch.setattr(tiles, "TILE", tile)
    monkeypatch.setattr(tiles, "PART", part)
    g = np.random.default_rng(tile)
    seed = g.integers(0, 2, 256)
    rows = []
    for _ in range(150):
        bits = seed.copy()
        bits[g.permutation(256)[:15]] ^= 1
        rows.append((bytearray(np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()),))
    frame = spark.createDataFrame(rows, "fingerprint binary").distinct().selectExpr("1L AS key", "fingerprint")
    found = components.components(tiles.keyed_links(frame, 45, 256)).collect()
    assert len({bytes(x["root"]) for x in found}) == 1 and len(found) == frame.count()


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "u long, v long")
    rows = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert set(rows) == {*range(61), 100, 101} and {rows[i] for i in range(61)} == {0} and rows[101] == 100
