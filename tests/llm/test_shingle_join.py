import random
from fractions import Fraction

import numpy as np
import pyarrow as pa

from textloom.llm import shingle_join, simhash


def shingles(text, k=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def jaccard_components(ids, texts, least=Fraction(4, 5)):
    """The least id of each text's component; ids may be null, which come first as in Spark."""
    sets, out, left = [shingles(t) for t in texts], {}, set(range(len(ids)))
    while left:
        todo, group = [left.pop()], []
        while todo:
            i = todo.pop()
            group.append(i)
            near = {j for j in left if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])}
            left -= near
            todo += near
        out |= dict.fromkeys(group, min((ids[i] for i in group), key=lambda x: (x is not None, x)))
    return [out[i] for i in range(len(ids))]


def near_texts(seed):
    """Texts of 8 to 400 words, each with copies that have a similarity from 0.6 to 1: words changed, put at the end or left out."""
    r, pool, texts = random.Random(seed), [f"w{i}" for i in range(3000)], ["", " ", "one", "ONE", "two"]
    for n in (8, 12, 24, 40, 68, 90, 200, 400) * 8:
        words = [r.choice(pool) for _ in range(n)]
        texts.append(" ".join(words))
        for share in (0.62, 0.69, 0.74, 0.79, 0.8, 0.81, 0.86):
            m, near = n - 4, list(words)
            kind = r.randrange(3)
            if kind == 0:
                for at in r.sample(range(n), max(1, round(m * (1 - share) / (1 + share) / 5))):
                    near[at] = "other"
            elif kind == 1:
                near += [r.choice(pool) for _ in range(int(m / share) - m)]
            else:
                near = near[: 4 + -int(-m * share // 1)]
            texts.append(" ".join(near))
    return texts


def test_keep_one_tests_the_exact_similarity(spark):
    texts = near_texts(3)
    want = jaccard_components(list(range(len(texts))), texts)
    out = simhash.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["doc_id"] for r in out.collect()} == set(want)


def test_large_candidate_components_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "PART", 7)
    r = random.Random(4)
    seed = [f"w{r.randrange(500)}" for _ in range(120)]
    texts = [" ".join([*seed[: r.randint(20, 120)], *(f"x{r.randrange(500)}" for _ in range(r.randint(0, 20)))]) for _ in range(90)]
    want = jaccard_components(list(range(90)), texts)
    for broadcast in (10**6, 0):
        monkeypatch.setattr(shingle_join, "BROADCAST_ROWS", broadcast)
        rows = shingle_join.near_sets(spark.createDataFrame(list(enumerate(texts)), "id long, text string")).collect()
        assert [x["component_id"] for x in sorted(rows)] == want and 1 < len(set(want)) < 90


def test_similar_sets_share_a_key_or_are_told(monkeypatch):
    least, g, told = Fraction(4, 5), np.random.default_rng(5), 0
    for load in (shingle_join.LOAD, 0.3):
        monkeypatch.setattr(shingle_join, "LOAD", load)
        for _ in range(1500):
            n = int(2 ** g.uniform(0, 10))
            h = g.integers(0, 2**64 - 1, 2 * n + 1, dtype=np.uint64)
            c = int(g.integers(-(-4 * n // 5), n + 1))
            x, y = np.sort(h[:n]), np.sort(np.concatenate((g.permutation(h[:n])[:c], h[n : n + 5 * c // 4 - n])))
            (a, f), (b, e) = (shingle_join.set_keys(s, least) for s in (x, y))
            told += bool(f | e)
            fine = frozenset(i for i in range(64) if (f | e) >> i & 1)
            assert np.intersect1d(a, b).size or fine
            assert np.intersect1d(shingle_join.set_keys(x, least, fine)[0], shingle_join.set_keys(y, least, fine)[0]).size
        assert bool(told) == (load == 0.3)


def test_linked_pairs_connect_as_by_brute_force():
    r = random.Random(6)
    for _ in range(60):
        pool = list(range(r.randint(3, 30)))
        sets = [set(r.sample(pool, r.randint(1, len(pool)))) for _ in range(r.randint(2, 25))]
        root = list(range(len(sets)))
        pairs = shingle_join.linked([np.array(sorted(s), np.uint64) for s in sets], Fraction(3, 5))
        assert all(5 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]) for i, j in pairs)
        for links in (pairs, [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j])]):
            found = list(root)
            for i, j in links:
                found = [found[i] if f == found[j] else f for f in found]
            if links is pairs:
                mine = found
        assert len(set(zip(mine, found, strict=True))) == len(set(mine)) == len(set(found))


def test_keys_of_several_sets(monkeypatch):
    r = random.Random(7)
    for _ in range(200):
        rows = sorted((r.randint(0, 6), r.randint(0, 3)) for _ in range(r.randint(0, 30)))
        want = sorted({x for x in rows if len({n for k, n in rows if k == x[0]}) > 1})
        cuts = sorted(r.randint(0, len(rows)) for _ in range(r.randint(0, 6)))
        batches = [pa.record_batch([pa.array([k for k, _ in part], pa.int64()), pa.array([n for _, n in part], pa.int64())], ["key", "number"]) for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True) for part in [rows[a:b]]]
        assert sorted(tuple(x.values()) for b in shingle_join._shared(iter(batches)) for x in b.to_pylist()) == want


def test_recall_and_false_drops_of_the_stage(spark):
    """Of pairs of random texts: all of similarity 0.8 or more are linked, none below is."""
    r, pool, rows, similar = random.Random(11), [f"w{i}" for i in range(5000)], [], {}
    for i in range(400):
        words = [r.choice(pool) for _ in range(r.randint(30, 400))]
        near = list(words)
        for at in r.sample(range(len(words)), max(1, round(len(words) * r.uniform(0.005, 0.06)))):
            near[at] = "other"
        a, b = shingles(" ".join(words)), shingles(" ".join(near))
        similar[2 * i + 1] = len(a & b) / len(a | b)
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(near))]
    kept = {x["doc_id"] for x in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(s >= 0.8 for s in similar.values()) > 100 < sum(s < 0.75 for s in similar.values())
    assert {i for i in similar if i not in kept} == {i for i, s in similar.items() if s >= 0.8}
