import hashlib
import random
import zlib

from textloom.llm import ogg, queries


def slow_checksum(data):
    crc = 0
    for b in data:
        crc ^= b << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if crc & 0x80000000 else (crc << 1) & 0xFFFFFFFF
    return crc


def test_checksum():
    r = random.Random(1)
    for n in (0, 1, 5, 300):
        data = r.randbytes(n)
        assert ogg.checksum(data) == slow_checksum(data)


def test_round_trip_and_time_stamps():
    r = random.Random(2)
    for n in (0, 1, 63, 64, 65, 1000, 100_000):
        payload = ogg.padded(r.randbytes(n))
        assert len(payload) % 64 == 0 and len(payload) >= 64
        for size in (100, 255, 2048, 70_000):
            media = ogg.read(ogg.write(payload, packet_samples=size))
            assert media.payload == payload and not media.bad_pages and not any(s.lost for s in media.streams)
            for s in media.streams:
                assert s.ends[1:] == [min((i + 1) * size, len(payload) // 2) for i in range(len(s.ends) - 1)]
            assert media.seconds() == len(payload) / 2 / 8000


def test_damage_is_found():
    data = bytearray(ogg.write(ogg.padded(bytes(range(256)) * 200)))
    data[len(data) // 2] ^= 1
    media = ogg.read(bytes(data))
    assert media.bad_pages == 1
    assert ogg.read(b"junk" + ogg.write(ogg.padded(b"x")) + b"tail").payload == ogg.padded(b"x")
    assert media.payload is None and media.joined()[1] == "pages are lost"
    assert ogg.read(None).streams == [] and ogg.read(b"OggS").payload is None


def pages_of(data):
    at = [i for i in range(len(data)) if data.startswith(b"OggS", i)]
    return [data[i:j] for i, j in zip(at, [*at[1:], len(data)], strict=True)]


def test_damage_of_each_kind_has_a_defined_result(spark):
    payload = ogg.padded(random.Random(5).randbytes(300_000))
    whole = ogg.write(payload)
    pages = pages_of(whole)
    assert b"".join(pages) == whole and len(pages) > 6
    cases = [(whole, None), (None, None), (b"", None)]
    for k in range(len(pages)):
        flipped = bytearray(pages[k])
        flipped[-1] ^= 1
        cases.append((b"".join([*pages[:k], bytes(flipped), *pages[k + 1 :]]), "lost"))
        cases.append((b"".join(pages[:k] + pages[k + 1 :]), "lost"))
    foreign = b"".join(p for _, p in ogg.pages(9, [(b"pcm8mono", 0), (b"x" * 500, 500)]))
    cases += [(foreign, "lost"), (b"junk", "lost"), (foreign + whole, None), (whole[: len(whole) // 2], "lost"), (whole + whole[: len(pages[0])], "lost")]
    rows = ogg.load(spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "id int, media binary")).collect()
    for r in rows:
        media, kind = cases[r["id"]]
        if kind is None:
            assert r["loaded"]["error"] is None and bytes(r["loaded"]["payload"]) == (payload if media else b""), r["id"]
        else:
            assert r["loaded"]["error"] and r["loaded"]["payload"] is None, r["id"]


def test_lost_page_loses_its_packets_only():
    packets = [(bytes([i]) * 40_000, i) for i in range(1, 6)]
    pages = [p for _, p in ogg.pages(7, packets)]
    del pages[2]
    stream = ogg.read(b"".join(pages)).streams[0]
    assert stream.lost and 0 < len(stream.packets) < 5 and all(p in [d for d, _ in packets] for p in stream.packets)


def test_query(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op5_media(spark, str(tmp_path)).collect()
    assert len(rows) == docs.count()
    by = {}
    for d in docs.collect():
        raw = (d["text"] or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        by.setdefault(d["doc_id"], set()).add((len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])))
    assert all((r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) in by[r["doc_id"]] for r in rows)
    same = {}
    for r in rows:
        assert same.setdefault(r["payload_sha256"], (r["media_sha256"], r["feature"])) == (r["media_sha256"], r["feature"])
