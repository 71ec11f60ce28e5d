import random
import time
from fractions import Fraction

import pytest
import xxhash

from textloom.llm import mixing, queries


def ideal(blocks, weights):
    """The blocks that the ideal mix has given each source at every slot, as fractions, slot by slot."""
    weights, given = [Fraction(w) for w in weights], [Fraction(0)] * len(blocks)
    yield list(given)
    for _ in range(sum(blocks)):
        time_left = Fraction(1)
        while time_left:
            active = [s for s, n in enumerate(blocks) if given[s] < n]
            total = sum(weights[s] for s in active)
            step = min([time_left, *((blocks[s] - given[s]) * total / weights[s] for s in active)])
            for s in active:
                given[s] += step * weights[s] / total
            time_left -= step
        yield list(given)


def brute_slots(blocks, weights):
    """(source, block) of every slot: of the released blocks that with the earliest deadline, looked for one by one."""
    course = list(ideal(blocks, weights))
    release = lambda s, i: max(t for t, g in enumerate(course) if g[s] <= i)
    deadline = lambda s, i: min(t for t, g in enumerate(course) if g[s] >= i + 1)
    done, out = [0] * len(blocks), []
    for t in range(sum(blocks)):
        s = min((deadline(s, done[s]), s) for s, n in enumerate(blocks) if done[s] < n and release(s, done[s]) <= t)[1]
        out.append((s, done[s]))
        done[s] += 1
    return out


def of_slots(slots):
    return [x for _, x in sorted((t, (s, i)) for s, own in enumerate(slots) for i, t in enumerate(own))]


def some_weights(r, n):
    return [r.choice((r.randint(1, 30), r.uniform(0.01, 9), r.randint(1, 9999) ** 0.5)) for _ in range(n)]


def test_schedule_as_by_brute_force():
    r = random.Random(2)
    for _ in range(120):
        n = r.randint(1, 7)
        blocks, weights = [r.randint(0, 12) for _ in range(n)], some_weights(r, n)
        assert of_slots(mixing.schedule(blocks, weights)) == brute_slots(blocks, weights)


def test_every_source_stays_within_a_block_of_its_share():
    r = random.Random(3)
    for _ in range(60):
        n = r.randint(1, 8)
        blocks, weights = [r.randint(0, 60) for _ in range(n)], some_weights(r, n)
        order, done = of_slots(mixing.schedule(blocks, weights)), [0] * n
        assert len(order) == sum(blocks)
        for t, share in enumerate(ideal(blocks, weights)):
            assert all(abs(share[s] - done[s]) < 1 for s in range(n))
            if t < len(order):
                s, i = order[t]
                assert i == done[s]
                done[s] += 1


@pytest.mark.parametrize("weights", [(1, 2), (0.99999, 0.00001), (3**0.5, 5**0.5, 7**0.5, 0.1)])
def test_no_drift_from_the_given_weights(weights):
    slots = 1_000_000
    total = sum(map(Fraction, weights))
    shares = [Fraction(w) / total for w in weights]
    plan = mixing.schedule([int(slots * s) - 1 for s in shares], weights)
    for own, share in zip(plan, shares, strict=True):
        # the ideal count before and after each block's slot, where it is farthest from the blocks done
        assert all(abs(share * t - i) < 1 and abs(share * (t + 1) - (i + 1)) < 1 for i, t in list(enumerate(own))[:: max(1, len(own) // 2000)] if t < 0.999 * slots)  # until the first source ends


def test_many_sources():
    start = time.monotonic()
    slots = mixing.schedule([1 + i % 20 for i in range(5000)], [1 + i % 97 for i in range(5000)])
    assert sorted(t for own in slots for t in own) == list(range(sum(1 + i % 20 for i in range(5000)))) and time.monotonic() - start < 30


def places(rows, block):
    """(block, slot, position) of every (doc_id, source), by brute force; default weights."""
    signed = lambda i: (xxhash.xxh64_intdigest(str(i).encode(), 42) + 2**63) % 2**64 - 2**63
    own = {}
    for i, s in rows:
        own.setdefault(s, []).append(i)
    names = sorted(own, key=lambda s: (s is not None, str(s)))
    cut = [[sorted(own[s], key=lambda i: (signed(i), i))[k : k + block] for k in range(0, len(own[s]), block)] for s in names]
    order = brute_slots([len(c) for c in cut], [len(own[s]) ** 0.5 for s in names])
    return {doc: (i, slot, slot * block + n) for slot, (s, i) in enumerate(order) for n, doc in enumerate(cut[s][i])}


def test_mix_keeps_every_row(docs, none, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 10)
    out = mixing.mix(docs, block=4)
    assert out.columns == [*docs.columns, "mix"] and out.count() == docs.count()
    rows = out.collect()
    assert len({r["mix"]["position"] for r in rows}) == len(rows)
    sizes = {}
    for r in rows:
        sizes.setdefault((r["source"], r["mix"]["block"]), []).append(r["mix"]["slot"])
    assert all(len(set(v)) == 1 for v in sizes.values())
    for source in {k[0] for k in sizes}:
        own = sorted((b, len(v)) for (s, b), v in sizes.items() if s == source)
        assert [b for b, _ in own] == list(range(len(own))) and all(n == 4 for _, n in own[:-1])
    assert mixing.mix(none).count() == 0
    with pytest.raises(ValueError, match="positive"):
        mixing.mix(docs, weights={None: 0, "src0": 1, "src1": 1, "src2": 1})


def test_partitions_do_not_matter(docs):
    rows = lambda d: sorted((str(r["doc_id"]), r["mix"]["position"]) for r in mixing.mix(d.dropDuplicates(["doc_id"]), block=4).collect())
    assert rows(docs) == rows(docs.repartition(7))


def test_query_as_by_brute_force(spark, monkeypatch, tmp_path):
    r = random.Random(4)
    rows = [(i, r.choice(("a", "b", "b", "b", None, "c d")), "t") for i in range(1500)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    want = places([x[:2] for x in rows], mixing.BLOCK)
    for group, segment in ((mixing.GROUP, mixing.SEGMENT), (50, 3)):
        monkeypatch.setattr(mixing, "GROUP", group)
        monkeypatch.setattr(mixing, "SEGMENT", segment)
        found = queries.op4_mix(spark, str(tmp_path)).collect()
        assert len(found) == len(rows) and {x["doc_id"]: (x["block"], x["slot"], x["position"]) for x in found} == want


def test_blocks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 12)
    docs = spark.createDataFrame([(i, "ab"[i % 7 == 0]) for i in range(2000)], "doc_id long, source string")
    rows = mixing.mix(docs).collect()
    assert len({x["mix"]["position"] for x in rows}) == 2000 and max(x["mix"]["slot"] for x in rows) < 12
    with pytest.raises(ValueError, match="blocks"):
        mixing.mix(docs, block=10)


def test_odd_names_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 20)
    docs = spark.createDataFrame([(None, f"x{i}", "a", i, 1) for i in range(200)], "`doc.id` long, `order` string, `so.urce` string, bits int, `rank` int")
    rows = mixing.mix(docs, key="doc.id", source="so.urce", block=8).collect()
    assert sorted(x["mix"]["position"] for x in rows) == list(range(200)) and rows[0].asDict().keys() == {*docs.columns, "mix"}
