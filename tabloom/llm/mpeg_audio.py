"""MPEG audio columns: a lossless store of bytes in MPEG frames, and a reader of MPEG audio streams.

The reader resynchronises on frame headers (a header counts when the next one, at the distance
its own length says, is compatible, or the stream ends there), parses ID3 and APE tags and the
Xing/Info and VBRI tables, verifies the frames' checksums (all layers), and gives the exact
duration (samples over sample rate) and the byte offset of every frame. In a free-format stream
the first two frames' distance gives the frame length. Frames whose version, layer or rate differ
from the first one's are skipped.

The writer puts a payload into MPEG-1 Layer III frames (32 kHz, mono, with checksum) whose side
information says that they hold no audio, so that the whole body of each frame is ancillary
data. All frames but the last have the highest bit rate; the last has the lowest that holds the
rest. A Xing frame with frame count, byte count and seek table goes first.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches

# Fixed values of the MPEG audio header (kbit/s by index; Hz by index).
BITRATES = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}  # by version bits
VERSIONS = {3: "1", 2: "2", 0: "2.5"}
#: Layer II: bits of the allocation of each subband, by table, as (subbands, bits) runs.
ALLOCATION = {"wide": ((11, 4), (12, 3), (4, 2)), "wider": ((11, 4), (12, 3), (7, 2)), "low": ((2, 4), (6, 3)), "low32": ((2, 4), (10, 3)), "half": ((4, 4), (7, 3), (19, 2))}
#: Bytes up to which the next frame of a free-format stream is looked for: 640 kbit/s at 8 kHz, of 1152 samples.
FREE_FRAME = 640_000 * 144 // 8000
#: Frames that have to follow each other before a stream counts as found.
SYNC_FRAMES = 2


def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        c = n << 8
        for _ in range(8):
            c = (c << 1) ^ 0x8005 if c & 0x8000 else c << 1
        out.append(c & 0xFFFF)
    return out


_CRC = _crc_table()


def crc16(data: bytes, value: int = 0xFFFF, bits: int = 0) -> int:
    """The checksum of MPEG audio: polynomial 8005, high bit first, from FFFF. bits: that many upper bits of the last byte count (0: all)."""
    for b in data[:-1] if bits else data:
        value = ((value << 8) & 0xFFFF) ^ _CRC[(value >> 8) ^ b]
    for k in range(bits):
        high = (value >> 15) ^ (data[-1] >> (7 - k) & 1)
        value = (value << 1) & 0xFFFF ^ 0x8005 * high
    return value


@dataclass(frozen=True, slots=True)
class Header:
    version: int  # as in the header: 3 is MPEG-1, 2 MPEG-2, 0 MPEG-2.5
    layer: int
    checked: bool
    kbps: int
    rate: int
    size: int
    samples: int
    mono: bool
    bound: int = 32  # subband from which two channels share an allocation (Layers I and II)
    pad: int = 0

    @property
    def allocation(self) -> tuple:
        """Layer II: the runs of the table that rate and bit rate choose."""
        if self.version != 3:
            return ALLOCATION["half"]
        each = self.kbps if self.mono else self.kbps // 2
        if each and each < 56:
            return ALLOCATION["low32" if self.rate == 32000 else "low"]
        return ALLOCATION["wider" if (each >= 96 or not each) and self.rate != 48000 else "wide"]

    @property
    def side(self) -> int:
        """Bytes of side information (Layer III)."""
        if self.layer != 3:
            return 0
        return (17 if self.mono else 32) if self.version == 3 else (9 if self.mono else 17)

    @property
    def kind(self) -> tuple:
        return self.version, self.layer, self.rate


def read_header(word: bytes, known: dict[bytes, Header | None]) -> Header | None:
    """The header in four bytes, or None if they are none. A free-format header has bit rate and size 0."""
    if word in known:
        return known[word]
    out = None
    if len(word) == 4 and word[0] == 0xFF and word[1] & 0xE0 == 0xE0:
        version, layer = (word[1] >> 3) & 3, 4 - ((word[1] >> 1) & 3)
        index, rate = word[2] >> 4, (word[2] >> 2) & 3
        if version != 1 and layer != 4 and index < 15 and rate < 3 and word[3] & 3 != 2:
            kbps = BITRATES[(1, layer) if version == 3 else (2, min(layer, 2))][index]
            hz, pad = RATES[version][rate], (word[2] >> 1) & 1
            samples = 384 if layer == 1 else 1152 if layer == 2 or version == 3 else 576
            size = (12 * kbps * 1000 // hz + pad) * 4 if layer == 1 else samples // 8 * kbps * 1000 // hz + pad
            joint = word[3] >> 6 == 1
            out = Header(version, layer, not word[1] & 1, kbps, hz, size if kbps else 0, samples, word[3] >> 6 == 3, 4 * (word[3] >> 4 & 3) + 4 if joint else 32, pad * (4 if layer == 1 else 1))
    if len(known) < 4096:
        known[word] = out
    return out


@dataclass
class Stream:
    tags: dict[str, str] = field(default_factory=dict)
    table: dict = field(default_factory=dict)  # of Xing, Info or VBRI
    kind: tuple | None = None
    offsets: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    kbps: set = field(default_factory=set)
    samples: int = 0
    rate: int = 0
    checked: int = 0  # frames whose checksum was computed
    wrong: int = 0  # of these, the ones that differ
    skipped: int = 0  # bytes that are neither tag nor frame
    body: list[tuple[int, int]] = field(default_factory=list)  # start and end of each frame's ancillary part

    @property
    def duration(self) -> Fraction:
        return Fraction(self.samples, self.rate) if self.rate else Fraction(0)


def _synchsafe(b: bytes) -> int:
    return b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]


def _id3v2(data: bytes, at: int, tags: dict[str, str]) -> int:
    """Length of the ID3v2 tag at `at`; its text frames go to tags."""
    size, major = _synchsafe(data[at + 6 : at + 10]), data[at + 3]
    end, p = min(len(data), at + 10 + size), at + 10
    short = major == 2
    while p + (6 if short else 10) <= end and data[p]:
        name = data[p : p + (3 if short else 4)].decode("latin-1")
        if short:
            n, p = int.from_bytes(data[p + 3 : p + 6], "big"), p + 6
        else:
            n, p = (_synchsafe if major == 4 else lambda b: int.from_bytes(b, "big"))(data[p + 4 : p + 8]), p + 10
        if name[0] == "T" and 0 < n <= end - p:
            code = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(data[p], "latin-1")
            value = data[p + 1 : p + n].decode(code, "replace").rstrip("\0")
            key, _, rest = value.partition("\0")
            tags.update({f"{name}:{key}": rest} if name in ("TXXX", "TXX") else {name: value})
        p += n
    return 10 + size + (10 if major == 4 and data[at + 5] & 0x10 else 0)


def _table(data: bytes, at: int, head: Header) -> dict:
    """The Xing, Info or VBRI table in the frame at `at`, if it has one."""
    p = at + 4 + 2 * head.checked + head.side
    if data[p : p + 4] in (b"Xing", b"Info"):
        flags, out, q = int.from_bytes(data[p + 4 : p + 8], "big"), {"table": data[p : p + 4].decode()}, p + 8
        for bit, name in ((1, "frames"), (2, "bytes")):
            if flags & bit:
                out[name], q = int.from_bytes(data[q : q + 4], "big"), q + 4
        if flags & 4:
            out["toc"], q = list(data[q : q + 100]), q + 100
        return out
    p = at + 36
    if data[p : p + 4] == b"VBRI":
        _, _, _, size, frames, entries, scale, width, per = struct.unpack(">HHHIIHHHH", data[p + 4 : p + 26])
        toc = [int.from_bytes(data[p + 26 + k * width : p + 26 + (k + 1) * width], "big") * scale for k in range(entries)]
        return {"table": "VBRI", "bytes": size, "frames": frames, "toc": toc, "frames_per_entry": per}
    return {}


def protected_bits(data: bytes, at: int, head: Header) -> int:
    """Bits after the checksum of the frame at `at` that the checksum covers: side information, or allocation and, in Layer II, scale factor selection."""
    if head.layer == 3:
        return 8 * head.side
    channels = 1 if head.mono else 2
    if head.layer == 1:
        return 4 * (32 if head.mono else 32 + min(head.bound, 32))
    p, used, chosen = (at + 6) * 8, 0, 0
    widths = [w for n, w in head.allocation for _ in range(n)]
    for band, w in enumerate(widths):
        shared = channels == 2 and band >= head.bound
        for _ in range(1 if shared or channels == 1 else 2):
            a = p + used
            word = int.from_bytes(data[a >> 3 : (a >> 3) + 2].ljust(2, b"\0"), "big")
            if word >> (16 - (a & 7) - w) & ((1 << w) - 1):
                chosen += channels if shared else 1
            used += w
    return used + 2 * chosen


def checksum_holds(data: bytes, at: int, head: Header, known: dict[bytes, int]) -> bool:
    """Whether the checksum of a protected frame is that of its header's last bytes and its protected bits."""
    bits = protected_bits(data, at, head)
    part = data[at + 2 : at + 4] + data[at + 6 : at + 6 + (bits + 7) // 8]
    if part not in known:
        if len(known) >= 4096:
            known.clear()
        known[part] = crc16(part, bits=bits & 7)
    return known[part] == int.from_bytes(data[at + 4 : at + 6], "big")


def _free_size(data: bytes, at: int, head: Header, known: dict) -> int:
    """Length without padding of the free-format frames from `at` on, or 0: the next two like headers must lie that far apart."""
    p = at + 4
    while (p := data.find(data[at : at + 2], p + 1, at + FREE_FRAME)) >= 0:
        near = read_header(data[p : p + 4], known)
        if near is not None and not near.size and near.kind == head.kind:
            size = p - at - head.pad
            q = p + size + near.pad
            after = read_header(data[q : q + 4], known)
            if q == len(data) or data[q : q + 3] in (b"TAG", b"APE") or after is not None and not after.size and after.kind == head.kind:
                return size
    return 0


def read_stream(data: bytes) -> Stream:
    """Parses bytes that may hold tags, junk, cut-off frames and an MPEG audio stream."""
    out, known, sums, at, n, in_step, free = Stream(), {}, {}, 0, len(data), False, 0
    while at < n:
        head = read_header(data[at : at + 4], known)
        if head is not None and not head.size:
            free = free or (_free_size(data, at, head, known) if out.kind is None else 0)
            head = replace(head, size=free + head.pad) if free else None
        elif head is not None and not in_step:
            p, near = at + head.size, head
            for _ in range(SYNC_FRAMES - 1):
                if p >= n or data[p : p + 3] in (b"TAG", b"APE"):
                    break
                near = read_header(data[p : p + 4], known)
                if near is None or not near.size or near.kind != head.kind:
                    head = None
                    break
                p += near.size
        if head is not None and (out.kind in (None, head.kind)) and at + head.size <= n:
            in_step = True
            if out.kind is None:
                out.kind, out.rate = head.kind, head.rate
                out.table = _table(data, at, head)
                if out.table:
                    at += head.size
                    continue
            out.offsets.append(at)
            out.sizes.append(head.size)
            out.kbps.add(head.kbps)
            out.samples += head.samples
            start = at + 4 + 2 * head.checked + head.side
            if head.checked:
                out.checked += 1
                out.wrong += not checksum_holds(data, at, head, sums)
            out.body.append((start, at + head.size))
            at += head.size
            continue
        in_step = False
        if data[at : at + 3] == b"ID3" and at + 10 <= n and max(data[at + 6 : at + 10]) < 128:
            at += _id3v2(data, at, out.tags)
        elif data[at : at + 3] == b"TAG" and n - at == 128:
            for name, a, b in (("title", 3, 33), ("artist", 33, 63), ("album", 63, 93), ("year", 93, 97)):
                out.tags[name] = data[at + a : at + b].rstrip(b"\0 ").decode("latin-1")
            at = n
        elif data[at : at + 8] == b"APETAGEX" and at + 32 <= n and data[at + 23] & 0x20:
            at += 32 + int.from_bytes(data[at + 12 : at + 16], "little")
        else:
            after = data.find(b"\xff", at + 1)
            marks = [x for x in (after, data.find(b"ID3", at + 1, after if after >= 0 else n), n - 128 if n - 128 > at and data[n - 128 : n - 125] == b"TAG" else -1) if x >= 0]
            to = min(marks, default=n)
            out.skipped += to - at
            at = to
    return out


#: The writer's frames: bit rates in kbit/s with their header and checksum, at 32 kHz.
_SIDE = 17


def _frame_start(index: int) -> bytes:
    head = bytes([0xFF, 0xFA, index << 4 | 2 << 2, 0xC4])
    return head + crc16(head[2:] + bytes(_SIDE)).to_bytes(2, "big") + bytes(_SIDE)


_STARTS = {k: _frame_start(k) for k in range(1, 15)}
_ROOM = {k: BITRATES[1, 3][k] * 9 // 2 - len(_STARTS[k]) for k in range(1, 15)}


def write_stream(payload: bytes) -> bytes:
    """An MPEG audio stream whose ancillary data is payload, and whose tag tells its length."""
    full, frames = _ROOM[14], []
    count = len(payload) // full
    start = _STARTS[14]
    frames = [start + payload[k * full : (k + 1) * full] for k in range(count)]
    rest = payload[count * full :]
    if rest or not frames:
        index = next(k for k in range(1, 15) if _ROOM[k] >= len(rest))
        frames.append(_STARTS[index] + rest + bytes(_ROOM[index] - len(rest)))
    audio = b"".join(frames)
    text = b"\x03payload_bytes\0" + str(len(payload)).encode()
    tag = b"TXXX" + bytes([0, 0, 0, len(text)]) + b"\0\0" + text
    tag = b"ID3\x04\0\0" + bytes([0, 0, len(tag) >> 7, len(tag) & 127]) + tag
    # The table's frame is as long as its own contents need: 288 bytes at 64 kbit/s.
    index, size = 5, 288
    step = len(frames[0])
    toc = bytes(min(255, (size + (k * len(frames) // 100) * step) * 256 // (size + len(audio))) for k in range(100))
    head = bytes([0xFF, 0xFB, index << 4 | 2 << 2, 0xC4]) + bytes(_SIDE)
    table = head + b"Xing" + struct.pack(">III", 7, len(frames), size + len(audio)) + toc
    return tag + table + bytes(size - len(table)) + audio


def read_payload(stored: bytes) -> tuple[bytes, Stream]:
    s = read_stream(stored)
    return b"".join([stored[a:b] for a, b in s.body])[: int(s.tags.get("TXXX:payload_bytes", 0))], s


def feature(s: Stream) -> str:
    """What a media column keeps of a stream, as text: exact duration, checksums, table and seek offsets."""
    seek = zlib.crc32(struct.pack(f"<{len(s.offsets)}q", *s.offsets))
    kind = f"mpeg{VERSIONS[s.kind[0]]} layer{s.kind[1]}" if s.kind else "none"
    return (
        f"{kind} rate={s.rate} kbps={min(s.kbps, default=0)}-{max(s.kbps, default=0)} frames={len(s.offsets)} samples={s.samples}"
        f" seconds={s.duration} table={s.table.get('table', 'none')}:{s.table.get('frames', 0)} checked={s.checked} wrong={s.wrong}"
        f" skipped={s.skipped} seek_crc32={seek}"
    )


def mpeg_column(docs: DataFrame, text: str = "text", ident: str = "doc_id", with_media: bool = False) -> DataFrame:
    """One row for each input row: its text stored as MPEG audio and read back.

    Columns: identifier, n_bytes (UTF-8, unpadded), payload_bytes (padded with zeros to a
    positive multiple of 64), payload_sha256 and tail_crc32 (last 64 bytes) of what was read
    back, media_bytes, media_sha256, feature, seconds (exact), seek_offsets (the byte at which
    each frame starts), and with with_media also media. Null counts as empty: 64 zero bytes. Rows are independent; equal texts
    give equal values.
    """
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[ident]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for value in batch.column(1):
                raw = (value.as_py() or "").encode()
                payload = raw + bytes(-len(raw) % 64 or (64 if not raw else 0))
                stored = write_stream(payload)
                back, s = read_payload(stored)
                row = (len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(s), f"{s.duration}", s.offsets)
                out.append((*row, stored) if with_media else row)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.binary()]
            columns = [pa.array(list(x), k) for x, k in zip(zip(*out, strict=True) if out else [()] * (10 if with_media else 9), kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", *_COLUMNS[: len(columns)]])

    shape = f"id {kind}, " + ", ".join(f"{c} {k}" for c, k in list(zip(_COLUMNS, _KINDS, strict=True))[: 10 if with_media else 9])
    return docs.select(docs[ident].alias("id"), docs[text].alias("text")).mapInArrow(run, shape).withColumnRenamed("id", ident)


_COLUMNS = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "seconds", "seek_offsets", "media"]
_KINDS = ["long", "long", "string", "long", "long", "string", "string", "string", "array<long>", "binary"]
