"""Removal of byte stretches that occur more than once, by suffix sorting in shards.

Two lengths are of interest: stretches of LENGTH bytes that occur more than once are removed, and
bytes of passages, stretches of PASSAGE bytes (less than any 51 words of usual prose) that also
occur in another document, are counted.

A shard must hold all places where a repeated stretch can start, so the corpus is cut by
content: in each window of PASSAGE bytes the k-gram with the smallest hash is the window's anchor
(the rightmost of equals), which equal windows share wherever they stand. Consecutive windows
with one anchor form a segment. Segments whose anchor hash is alone in the corpus hold nothing
that repeats. A segment's bytes go on to the end of the longer stretch. Equal segments are counted together; the different segments of one anchor hash
meet in a shard, where induced sorting (induced_sort.py) finds the windows that they share.

Shards hold about SHARD_BYTES, which small tasks make; each is read as a stream and sorted
externally, so that a larger one needs disk and no more memory. An anchor with very many different segments is cut into blocks
and each pair of blocks shares a shard, so that no task grows with the corpus.
"""

from __future__ import annotations

import hashlib
import math
import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, discard, drop_shuffles, materialise, mix64, release, utf8_column
from .induced_sort import MEMORY_BYTES, repeated_starts

LENGTH, PASSAGE = 400, 288
#: Bytes of a k-gram: a power of two, and more than the lines that many texts share.
GRAM = 128
SHARD_BYTES, SEGMENT_BLOCK = 3 << 20, 4096
#: Bytes of a text that are hashed at once; a longer text is taken in overlapping parts.
PART = 1 << 20
_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def anchors(data: np.ndarray, length: int = PASSAGE, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the anchor's k-gram, its place, first and last window start) of each segment of one text, in order."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    found = []
    for a in range(0, n - length + 1, PART):
        part = data[a : a + PART + length - 1]
        h, m = _CODES[part], 1
        while m < gram:
            h = (h[:-m] * np.uint64(0x9FB21C651E98DF25)) ^ h[m:]
            h ^= h >> np.uint64(32)
            m *= 2
        h = mix64(h)
        w = length - gram + 1
        last = len(h)
        # The upper bits decide; on a tie the rightmost place has the smallest lower bits.
        low = np.uint64((1 << 24) - 1)
        v = (h & ~low) | (low - np.arange(last, dtype=np.uint64))
        rows = -(-last // w)
        padded = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
        padded[:last] = v
        block = padded.reshape(rows, w)
        ahead = np.minimum.accumulate(block, 1).ravel()
        back = np.minimum.accumulate(block[:, ::-1], 1)[:, ::-1].ravel()
        least = np.minimum(back[: last - w + 1], ahead[w - 1 : last])
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        first = np.concatenate([[0], cut])
        final = np.concatenate([cut, [len(least)]]) - 1
        place = (low - (least[first] & low)).astype(np.int64)
        found.append((h[place], place + a, first + a, final + a))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(r, q, text) to a row (r, q, h, g, s) for each segment; g is a digest of its bytes and its anchor's place in it.

    s is its first window start << 20, how much later its last one is << 10, and its anchor's place after the first.
    """
    for batch in batches:
        data, offsets = utf8_column(batch.column(2))
        owners, columns, digests = [], [], []
        size = 0

        def out():
            h, place = (np.concatenate(x) for x in zip(*columns, strict=True))
            at = pa.array(np.concatenate(owners))
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(h.view(np.int64)), pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(place)],
                names=["r", "q", "h", "g", "s"],
            )

        for k in range(len(offsets) - 1):
            text = data[offsets[k] : offsets[k + 1]]
            h, place, first, last = anchors(text)
            if not len(h):
                continue
            raw = memoryview(text.tobytes())
            digests += [xxhash.xxh3_64_intdigest(raw[a : b + LENGTH], p - a) for p, a, b in zip(place.tolist(), first.tolist(), last.tolist(), strict=True)]
            owners.append(np.full(len(h), k))
            columns.append((h, first << 20 | (last - first) << 10 | (place - first)))
            size += len(h)
            if size > 100_000:
                yield out()
                owners, columns, digests, size = [], [], [], 0
        if size:
            yield out()
    release()


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(r, q, text, wanted list of (h, g, n, many, spread, s)) to a row (r, q, h, g, n, many, spread, s, piece) for each wanted segment."""
    for batch in batches:
        texts, wanted = batch.column(2), batch.column(3)
        lists = wanted.flatten()
        counts = np.diff(wanted.offsets.to_numpy())
        owner = np.repeat(np.arange(batch.num_rows), counts)
        h, g, n, many, spread, place = (lists.field(k) for k in range(6))
        s = place.to_numpy()
        begin, end = s >> 20, (s >> 20) + (s >> 10 & 1023)
        at, raw = -1, b""
        for first in range(0, len(owner), 5000):
            pieces, some = [], slice(first, first + 5000)
            for k, x, y in zip(owner[some].tolist(), begin[some].tolist(), end[some].tolist(), strict=True):
                if k != at:
                    at, raw = k, texts[k].as_py().encode()
                pieces.append(raw[x : y + LENGTH])
            part = lambda c, first=first: c.slice(first, 5000)
            own = pa.array(owner[some])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(own), batch.column(1).take(own), part(h), part(g), part(n), part(many), part(spread), part(place), pa.array(pieces, pa.binary())],
                names=["r", "q", "h", "g", "n", "many", "spread", "s", "piece"],
            )
    release()


def may_share(anchor: list[int], place: list[int], pieces: list[bytes]) -> np.ndarray:
    """Which segments can have a window in common with another one of their anchor.

    A common window holds the anchor's k-gram and PASSAGE - GRAM more bytes, so that on one side of
    the k-gram at least half as many are alike.
    """
    side = (PASSAGE - GRAM + 1) // 2
    before = [(h, x[p - side : p]) if p >= side else None for h, p, x in zip(anchor, place, pieces, strict=True)]
    after = [(h, x[p + GRAM : p + GRAM + side]) for h, p, x in zip(anchor, place, pieces, strict=True)]
    seen, seen_after = Counter(before), Counter(after)
    return np.array([b is not None and seen[b] > 1 or seen_after[a] > 1 and len(a[1]) == side for b, a in zip(before, after, strict=True)], bool)


class _Shard:
    """The segments of one shard: their bytes in a file beyond a bound, and a few numbers of each."""

    def __init__(self, memory: int):
        self.memory, self.size = memory, 0
        self.bytes = tempfile.SpooledTemporaryFile(memory // 8)
        self.rows: list[tuple] = []  # r, q, s, many, spread, bytes

    def add(self, group: list[tuple]) -> None:
        """Segments (h, g, r, q, many, spread, s, piece) of one anchor, in order of g."""
        group = [x for k, x in enumerate(group) if not k or x[1] != group[k - 1][1]]
        for x, some in zip(group, may_share([x[0] for x in group], [x[6] & 1023 for x in group], [x[7] for x in group]), strict=True):
            if some:
                self.rows.append((x[2], x[3], x[6], x[4], x[5], len(x[7])))
                self.bytes.write(x[7])
                self.size += len(x[7])

    def strings(self) -> Iterator[bytes]:
        self.bytes.seek(0)
        for x in self.rows:
            yield self.bytes.read(x[5])

    def runs(self) -> Iterator[pa.RecordBatch]:
        """Runs (r, q, x, y, kind) of window starts: kind 1 repeat at LENGTH, 2 at PASSAGE in another document, 3 both."""
        if not self.rows:
            return
        r, q, s, many, spread = (np.array([x[k] for x in self.rows]) for k in range(5))
        owners = np.unique(np.stack([r, q], 1), axis=0, return_inverse=True)[1].ravel()
        hits = repeated_starts(self.strings(), LENGTH, (s >> 10 & 1023) + 1, many > 1, self.memory, PASSAGE, owners, spread.astype(bool), self.size)
        rows: list[tuple] = []
        # Places of a segment that occurs several times repeat anyway; where its copies are in one document, passages are still to be found.
        for (own, lane, place, _, several, _), hit in zip(self.rows, hits, strict=True):
            if several or not hit.any():
                continue
            a = place >> 20
            cuts = [0, *(np.flatnonzero(hit[1:] != hit[:-1]) + 1).tolist(), len(hit)]
            rows += [(own, lane, a + x, a + y - 1, int(hit[x])) for x, y in zip(cuts[:-1], cuts[1:], strict=True) if hit[x]]
            if len(rows) > 50_000:
                yield _run_batch(rows)
                rows = []
        if rows:
            yield _run_batch(rows)


def _run_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["r", "q", "x", "y", "kind"])


def _sort_shards(memory: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, h, g, r, q, many, spread, s, piece), sorted by the first three, to the runs of each shard. A row at a time is held, and an anchor's block."""
    shard, last, group = None, None, []
    for batch in batches:
        columns = [*(batch.column(k).to_numpy(zero_copy_only=False).tolist() for k in range(8)), batch.column(8).to_pylist()]
        for number, *row in zip(*columns, strict=True):
            if (number, row[0]) != last:
                if group:
                    shard.add(group)
                    group = []
                if last is None or number != last[0]:
                    if shard is not None:
                        yield from shard.runs()
                    shard = _Shard(memory)
                last = number, row[0]
            group.append(row)
    if shard is not None:
        if group:
            shard.add(group)
        yield from shard.runs()
    release()


def covered_runs(starts: list[tuple[int, int]], n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs (begin, end) of bytes covered by windows of `length` that start in any of the given runs and fit into n bytes."""
    out: list[list[int]] = []
    for x, y in sorted(starts):
        end = min(y, n - length) + length
        if end < x + length:
            continue
        if out and x <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([x, end])
    return [(a, b) for a, b in out]


def suffix_dedup(docs: DataFrame, text: str = "text", ident: str = "doc_id", with_text: bool = False, shard_bytes: int = SHARD_BYTES, memory: int = MEMORY_BYTES) -> DataFrame:
    """One row for each input row: identifier, n_bytes, n_removed, n_spans, kept_sha256, n_passage_bytes, n_passages, and with with_text kept (binary) and spans.

    Texts are UTF-8 bytes, null counts as empty. Each byte covered by a stretch of 400 bytes that
    also starts anywhere else, in the same document or another, is removed, judged on the input;
    overlaps count and matches never cross documents. Repeated rows and equal texts repeat each
    other, so from 400 bytes on nothing of them stays. n_passage_bytes counts the bytes covered by
    a stretch of 288 bytes that also starts in another document, n_passages their maximal runs;
    rows equal in identifier and text are one document there. Identifiers may be null. An empty
    table gives an empty result. A shard may be far larger than the memory that its sort may take.
    """
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[ident]
    given = docs.select(docs[ident].alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    # A document is named by 120 bits of a digest of its identifier and its text, the identifier's length before both.
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    name = F.md5(F.concat(F.col("id").isNull().cast("string"), F.length(name).cast("string"), F.lit(":"), name, F.col("text")).cast("binary"))
    given = given.withColumn("rid", name)
    lanes = [F.conv(F.substring("rid", k, 15), 16, 10).cast("long").alias(c) for k, c in ((1, "r"), (16, "q"))]
    given = given.select("id", "text", *lanes)
    segments = given.where(F.octet_length("text") >= PASSAGE).select("r", "q", "text").mapInArrow(_segments, "r long, q long, h long, g long, s long")
    every = materialise(segments, "suffix-segments")
    # Segments whose anchor is alone go first, by counts of the anchors only, so that no wide row of theirs is dealt out.
    met = materialise(every.groupBy("h").agg(F.count(F.lit(1)).alias("all")).where("all > 1").select("h"), "suffix-anchors")
    segments = materialise(every.join(met, "h", "left_semi"), "suffix-met")
    discard(every, met)
    drop_shuffles(docs.sparkSession)

    # Columns of fixed width, so that groups are hashed; a group's first row gives all of r, q and s.
    spread = F.min("r") != F.max("r")  # 60 bits tell the documents of one segment apart
    classes = segments.groupBy("h", "g").agg(F.count(F.lit(1)).alias("many"), spread.alias("spread"), *[F.first(c).alias(c) for c in ("r", "q", "s")])
    anchor = classes.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    classes = materialise(classes.join(anchor, "h"), "suffix-classes")
    drop_shuffles(docs.sparkSession)
    # All windows of a segment that occurs several times repeat, in each of its places.
    often = classes.where("many > 1").select("h", "g", (F.col("spread").cast("int") * 2 + 1).alias("kind"))
    begin = F.shiftright("s", 20)
    whole = segments.join(often, ["h", "g"]).select("r", "q", begin.alias("x"), (begin + F.shiftright("s", 10).bitwiseAND(1023)).alias("y"), "kind")
    # Anchors with several different segments go to the shards.
    mixed = classes.where("n > 1").select("r", "q", F.struct("h", "g", "n", "many", "spread", "s").alias("want"))
    wanted = mixed.groupBy("r", "q").agg(F.collect_list("want").alias("wanted"))  # no more than a text has segments
    once = given.select("r", "q", "text").join(wanted, ["r", "q"]).dropDuplicates(["r", "q"])
    pieces = once.mapInArrow(_fetch, "r long, q long, h long, g long, n long, many long, spread boolean, s long, piece binary")
    pieces = materialise(pieces, "suffix-pieces")
    drop_shuffles(docs.sparkSession)
    total = pieces.agg(F.coalesce(F.sum(F.octet_length("piece")), F.lit(0))).first()[0]
    shards = max(1, math.ceil(total / shard_bytes))
    # As in the pairs of blocks of near_dedup: one block, and one row, for all but very common anchors.
    blocks = F.ceil(F.col("n") / SEGMENT_BLOCK).cast("int")
    rows = pieces.withColumn("own", F.pmod(F.xxhash64("g"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("h", F.least("own", "other"), F.greatest("own", "other")), F.lit(shards)))
    rows = rows.select("shard", "h", "g", "r", "q", "many", "spread", "s", "piece").repartitionByRange(shards, "shard")  # one shard a task, which hashing wouldn't give
    some = rows.sortWithinPartitions("shard", "h", "g").mapInArrow(partial(_sort_shards, memory), "r long, q long, x long, y long, kind int")
    # What repeats is written before the texts are dealt out again, so that the pieces are gone by then.
    found = materialise(whole.union(some), "suffix-starts")
    discard(segments, classes, pieces)
    drop_shuffles(docs.sparkSession)
    starts = found.groupBy("r", "q").agg(F.collect_set(F.struct("x", "y", "kind")).alias("starts"))  # no more than a text has windows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            lists = batch.column(2)
            x, y, marks = (lists.flatten().field(k).to_numpy().tolist() for k in range(3))
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)).tolist()
            for value, a, b in zip(batch.column(1), [0, *ends[:-1]], ends, strict=True):
                raw = value.as_py().encode()
                spans = covered_runs([(x[k], y[k]) for k in range(a, b) if marks[k] & 1], len(raw))
                passages = covered_runs([(x[k], y[k]) for k in range(a, b) if marks[k] & 2], len(raw), PASSAGE)
                at, kept = 0, []
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                body = b"".join([*kept, raw[at:]])
                row = (len(raw), sum(b - a for a, b in spans), len(spans), hashlib.sha256(body).hexdigest(), sum(b - a for a, b in passages), len(passages))
                out.append((*row, body, [f"{a}:{b}" for a, b in spans]) if with_text else row)
            columns = [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", *names])
        release()

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_bytes", "n_passages", "kept", "spans"][: 8 if with_text else 6]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string())][: len(names)]
    shape = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_bytes long, n_passages long" + ", kept binary, spans array<string>" * with_text
    out = given.join(starts, ["r", "q"], "left").select("id", "text", "starts").mapInArrow(cut, shape)
    return out.withColumnRenamed("id", ident)
