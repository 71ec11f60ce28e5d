"""Media columns in Ogg: pages with checksums, packets, logical streams and time stamps."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import with_made

#: Fixed values of the Ogg format (RFC 3533).
CAPTURE, CONTINUED, FIRST, LAST, NO_GRANULE = b"OggS", 1, 2, 4, -1
HEADER = struct.Struct("<4sBBqIIIB")
MOST_SEGMENTS = 255

#: This writer's own stream header: a name, the channel's number, the channels, samples a second.
OPENING = struct.Struct("<8sBBI")
NAME = b"pcm8mono"

_MIRROR = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def checksum(data: bytes) -> int:
    """Ogg's CRC: zlib's polynomial without its mirroring, initial value and final inversion."""
    mirrored = zlib.crc32(data.translate(_MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(mirrored.to_bytes(4, "little").translate(_MIRROR), "big")


def padded(data: bytes, unit: int = 64) -> bytes:
    return data + bytes(unit - len(data) % unit if len(data) % unit or not data else 0)


def pages(serial: int, packets: list[tuple[bytes, int]]) -> list[tuple[int, bytes]]:
    """The pages of one logical stream, each with the granule it is in order at.

    packets: data and granule position at its end. The first packet has a page of its own.
    """
    out: list[tuple[int, bytes]] = []
    lacing, body, granule, passed, flags = bytearray(), bytearray(), NO_GRANULE, 0, FIRST

    def close(more: int, last: bool) -> None:
        nonlocal lacing, body, granule, flags
        head = HEADER.pack(CAPTURE, 0, flags | (LAST if last else 0), granule, serial, len(out), 0, len(lacing)) + lacing
        crc = checksum(bytes(head) + bytes(body))
        out.append((passed, head[:22] + crc.to_bytes(4, "little") + head[26:] + bytes(body)))
        lacing, body, granule, flags = bytearray(), bytearray(), NO_GRANULE, more

    for i, (data, end) in enumerate(packets):
        sizes = [255] * (len(data) // 255) + [len(data) % 255]
        at = 0
        for j, n in enumerate(sizes):
            if len(lacing) == MOST_SEGMENTS:
                close(CONTINUED if j else 0, False)
            lacing.append(n)
            body += data[at : at + n]
            at += n
        granule, passed = end, end
        if i == 0 and len(packets) > 1:
            close(0, False)
    close(0, True)
    return out


def write(payload: bytes, rate: int = 8000, packet_samples: int = 2048, channels: int = 2) -> bytes:
    """The payload's bytes as 8-bit samples, dealt to ``channels`` logical streams and multiplexed.

    Serial numbers follow from the payload, so equal payloads have equal files.
    """
    start = zlib.crc32(payload)
    first, rest = [], []
    for c in range(channels):
        samples = payload[c::channels]
        packets = [(OPENING.pack(NAME, c, channels, rate), 0)]
        packets += [(samples[i : i + packet_samples], min(i + packet_samples, len(samples))) for i in range(0, len(samples), packet_samples)]
        own = pages((start + c) & 0xFFFFFFFF, packets)
        first.append(own[0][1])
        rest += [(granule, c, k, page) for k, (granule, page) in enumerate(own[1:])]
    return b"".join(first + [x[3] for x in sorted(rest, key=lambda x: x[:3])])


@dataclass(eq=False)
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    #: the granule position at each packet's end; -1 where the file doesn't tell
    ends: list[int] = field(default_factory=list)
    pages: int = 0
    lost: int = 0
    #: whether the page that is marked as the last has come
    ended: bool = False
    _open: bytearray | None = None
    _next: int = 0

    def take(self, flags: int, granule: int, sequence: int, lacing: bytes, body: memoryview) -> None:
        gap = sequence != self._next
        self.ended = bool(flags & LAST)
        if gap or not flags & CONTINUED:
            self.lost += self._open is not None or gap
            self._open = None
        skip = bool(flags & CONTINUED) and self._open is None  # the rest of a packet whose start is lost
        self._next, self.pages, at, done = sequence + 1, self.pages + 1, 0, []
        part = self._open or bytearray()
        ended = True
        for n in lacing:
            part += body[at : at + n]
            at += n
            ended = n < 255
            if ended:
                if not skip:
                    done.append(bytes(part))
                part, skip = bytearray(), False
        self._open = None if ended or skip else part
        end, ends = granule, []
        for packet in reversed(done):  # the page's granule is where its last whole packet ends
            ends.append(end if granule >= 0 else -1)
            end = max(0, end - len(packet))
        self.packets += done
        self.ends += ends[::-1]


@dataclass
class Media:
    streams: list[Stream]
    bad_pages: int

    def own(self) -> dict[Stream, tuple[int, int, int]]:
        """This writer's streams, with the number of the channel, the channels and the samples a second that they open with."""
        out = {}
        for s in self.streams:
            if s.packets and len(s.packets[0]) == OPENING.size and s.packets[0].startswith(NAME):
                out[s] = OPENING.unpack(s.packets[0])[1:]
        return out

    def joined(self) -> tuple[bytes | None, str | None]:
        """The samples of all channels of this writer's streams, together again; or null, and why they can't be."""
        own = self.own()
        if not own:
            return None, "no stream of this writer"
        channels = {n for _, n, _ in own.values()}
        if len(channels) > 1 or sorted(c for c, _, _ in own.values()) != list(range(*channels)):
            return None, "the channels aren't those that the streams tell of"
        n = channels.pop()
        if any(s.lost or not s.ended for s in own):
            return None, "pages are lost"
        samples = {c: b"".join(s.packets[1:]) for s, (c, _, _) in own.items()}
        out = bytearray(sum(map(len, samples.values())))
        if any(len(out[c::n]) != len(x) or (s.ends[-1] if len(s.packets) > 1 else 0) != len(x) for s, (c, _, _) in own.items() for x in [samples[c]]):
            return None, "samples are lost"
        for c, x in samples.items():
            out[c::n] = x
        return bytes(out), None

    @property
    def payload(self) -> bytes | None:
        return self.joined()[0]

    def seconds(self) -> float:
        return max((s.ends[-1] / rate for s, (_, _, rate) in self.own().items() if rate), default=0.0)


def read(data: bytes | None) -> Media:
    """Pages whose checksum fails are passed over and counted; packets that lack a page are lost."""
    data = data or b""
    streams: dict[int, Stream] = {}
    at, bad = 0, 0
    whole = memoryview(data)
    while (at := data.find(CAPTURE, at)) >= 0 and at + HEADER.size <= len(data):
        _, version, flags, granule, serial, sequence, crc, n = HEADER.unpack_from(data, at)
        lacing = data[at + HEADER.size : at + HEADER.size + n]
        end = at + HEADER.size + n + sum(lacing)
        if version or len(lacing) < n or end > len(data) or checksum(data[at : at + 22] + bytes(4) + data[at + 26 : end]) != crc:
            bad, at = bad + 1, at + 4
            continue
        streams.setdefault(serial, Stream(serial)).take(flags, granule, sequence, lacing, whole[at + HEADER.size + n : end])
        at = end
    return Media(list(streams.values()), bad)


def feature(media: Media, payload: bytes | None) -> str:
    payload = payload or b""
    counts = f"streams={len(media.streams)} pages={sum(s.pages for s in media.streams)} packets={sum(len(s.packets) for s in media.streams)}"
    return f"{counts} bad={media.bad_pages} lost={sum(s.lost for s in media.streams)} seconds={media.seconds():.6f} silence={payload.count(0)} kinds={len(set(payload))}"


def _loaded(data: bytes | None) -> dict:
    found = read(data)
    payload, error = found.joined() if data else (b"", None)
    return {
        "payload": payload,
        "streams": len(found.streams),
        "pages": sum(s.pages for s in found.streams),
        "packets": sum(len(s.packets) for s in found.streams),
        "bad_pages": found.bad_pages,
        "seconds": found.seconds(),
        "feature": feature(found, payload),
        "error": error,
    }


def store(df: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """Add a binary column: each whole text's UTF-8, padded with bytes 0 to a positive multiple of 64, as Ogg.

    Null is an empty text, whose payload is 64 bytes 0. All rows and columns stay; a column
    already named ``media`` is an error.
    """
    return with_made(df, text, media, T.BinaryType(), lambda: lambda v: write(padded((v or "").encode())))


def load(df: DataFrame, media: str = "media", into: str = "loaded") -> DataFrame:
    """Add a struct read back from the stored bytes: payload, streams, pages, packets, bad_pages, seconds, feature, error.

    Null and empty media have an empty payload and no streams. Bytes from which not every
    sample of every channel can be had have a null payload, and error tells why: no
    stream of this writer, channels that are missing, pages or samples that are lost.
    """
    kind = T.StructType.fromDDL("payload binary, streams int, pages int, packets bigint, bad_pages int, seconds double, feature string, error string")
    return with_made(df, media, into, kind, lambda: _loaded)


def tail_crc32(payload: str) -> F.Column:
    """The unsigned CRC-32 of a binary column's last 64 bytes."""
    return F.crc32(F.substring(payload, -64, 64))
