"""Byte-level BPE by merge ranks, with a hierarchical-bitmap rank queue.

The queue has a bucket for each merge rank that holds positions of a linked list of parts. A
bitmap of three levels of 64 bits tells which buckets are in use; find-first-set at each level
gives the lowest rank in constant time. Entries are never removed when a neighbour merges: an
entry whose pair has changed by the time it is taken is stale and skipped. Merging a pre-token
of n bytes takes O(n) queue operations (plus keeping a bucket's positions in order), so one of a
million bytes is no special case.

Most pre-tokens are short, so the unknown ones of a batch share one queue (merge_many): merges in
different pre-tokens don't touch each other, and a bucket is then merged at once in numpy.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, release

#: Pieces whose ids a task remembers from batch to batch (about), and the longest such piece in characters.
CACHE_PIECES, CACHE_CHARS = 100_000, 8
#: Characters of text whose pieces are held at once, and fewest pre-tokens that share a queue.
GROUP_CHARS, FEW = 4 << 20, 256


class RankQueue:
    """Positions by rank; pop() gives a position of the lowest rank, the leftmost first."""

    __slots__ = ("buckets", "top", "middle", "low")

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}
        self.top, self.middle, self.low = 0, {}, {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            b = rank >> 6
            low = self.low
            if b in low:
                low[b] |= 1 << (rank & 63)
            else:
                low[b] = 1 << (rank & 63)
                a = b >> 6
                self.middle[a] = self.middle.get(a, 0) | 1 << (b & 63)
                self.top |= 1 << a
        elif position > bucket[-1] and len(bucket) == 1:
            bucket.append(position)
        else:
            heappush(bucket, position)

    def take(self) -> tuple[int, list[int]]:
        """The lowest rank and all its positions, left to right; its bucket is then empty."""
        top = self.top
        a = (top & -top).bit_length() - 1
        middle = self.middle[a]
        b = (a << 6) | ((middle & -middle).bit_length() - 1)
        low = self.low[b]
        bit = low & -low
        rank = (b << 6) | (bit.bit_length() - 1)
        low ^= bit
        if low:
            self.low[b] = low
        else:
            del self.low[b]
            middle &= middle - 1
            if middle:
                self.middle[a] = middle
            else:
                del self.middle[a]
                self.top = top & (top - 1)
        bucket = self.buckets.pop(rank)
        if len(bucket) > 1:
            bucket.sort()
        return rank, bucket


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank merges first, the leftmost of equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that starts here; 0 once it is merged away
    before = list(range(-1, n - 1))
    queue, get = RankQueue(), ranks.get
    push = queue.push
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            push(rank, i)
    while queue.top:
        rank, positions = queue.take()
        for k, i in enumerate(positions):
            middle = end[i]
            if not middle or middle >= n:
                continue
            stop = end[middle]
            if get(piece[i:stop]) != rank:
                continue  # stale
            end[i], end[middle] = stop, 0
            again = n
            if stop < n:
                before[stop] = i
                new = get(piece[i : end[stop]])
                if new is not None:
                    push(new, i)
                    again = new
            if i:
                left = before[i]
                new = get(piece[left:stop])
                if new is not None:
                    push(new, left)
                    again = min(again, new) if again != n else new
            if again < rank and k + 1 < len(positions):  # a lower rank came up: it goes first
                for j in positions[k + 1 :]:
                    push(rank, j)
                break
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class PairTable:
    """Ranks of pairs of ids, by open addressing in numpy."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        self.shift = np.uint64(64 - max(4, int(len(pairs) * 4).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.mask = size - 1
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        slots = self._slots(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[slots[left]] < 0]
            self.keys[slots[free]] = keys[free]
            self.values[slots[free]] = values[free]
            left = left[self.keys[slots[left]] != keys[left]]
            slots[left] = (slots[left] + 1) & self.mask
        won = self.keys >= 0
        self.values[won] = [pairs[k] for k in self.keys[won].tolist()]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        keys = left.astype(np.int64) << 32 | right
        slots = self._slots(keys)
        seen = self.keys[slots]
        out = np.where(seen == keys, self.values[slots], -1)
        more = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(more):
            slots[more] = (slots[more] + 1) & self.mask
            seen = self.keys[slots[more]]
            hit = seen == keys[more]
            out[more[hit]] = self.values[slots[more[hit]]]
            more = more[~hit & (seen >= 0)]
        return out


def merge_many(tokens: list[bytes], ranks: dict[bytes, int], pairs: PairTable) -> list[list[int]]:
    """Ids of each pre-token, as merge() gives them, from one queue over all of them."""
    data = np.frombuffer(b"".join(tokens), np.uint8)
    n = len(data)
    ends = np.cumsum([len(t) for t in tokens])
    owner = np.repeat(np.arange(len(tokens)), np.diff(ends, prepend=0))
    ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)[data]
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends - 1] = -1
    before[ends[:-1]] = before[0] = -1
    rank_at = np.full(n, -1, np.int32)
    has = np.flatnonzero(after >= 0)
    rank_at[has] = pairs.find(ids[has], ids[has + 1])
    alone = set()
    queue, buckets = RankQueue(), {}

    def push(places: np.ndarray, found: np.ndarray) -> None:
        order = np.argsort(found, kind="stable")
        found, places = found[order], places[order]
        cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
        begin = 0
        for stop in [*cuts.tolist(), len(found)]:
            rank = int(found[begin])
            if rank in buckets:
                buckets[rank].append(places[begin:stop])
            else:
                buckets[rank] = [places[begin:stop]]
                queue.push(rank, 0)
            begin = stop

    has = np.flatnonzero(rank_at >= 0)
    if len(has):
        push(has, rank_at[has])
    while queue.top:
        rank, _ = queue.take()
        held = buckets.pop(rank)
        at = np.unique(np.concatenate(held)) if len(held) > 1 else np.sort(held[0])
        at = at[rank_at[at] == rank]  # the others are stale
        if not len(at):
            continue
        right = after[at]
        tied = np.flatnonzero(right[:-1] == at[1:])
        if len(tied):  # overlapping pairs: every second one of a run, from the left
            runs = np.zeros(len(at), np.int64)
            runs[tied + 1] = 1
            start = np.maximum.accumulate(np.where(runs == 0, np.arange(len(at)), 0))
            even = (np.arange(len(at)) - start) % 2 == 0
            at, right = at[even], right[even]
        beyond = after[right]
        ids[at], after[at], rank_at[right], rank_at[at] = rank, beyond, -1, -1
        inner = beyond >= 0
        before[beyond[inner]] = at[inner]
        left = before[at]
        places = np.concatenate([at[inner], left[left >= 0]])
        if not len(places):
            continue
        found = pairs.find(ids[places], ids[after[places]])
        rank_at[places] = found
        some = found >= 0
        places, found = places[some], found[some]
        early = found <= rank
        if early.any():  # a lower rank came up; where a tie was merged too, order would matter
            alone.update(owner[places[early]].tolist())
        if len(places):
            push(places, found)
    out: list[list[int]] = []
    heads = np.concatenate([[0], ends[:-1]])
    alive = np.zeros(n, bool)
    place = heads
    while len(place):
        alive[place] = True
        place = after[place]
        place = place[place >= 0]
    kept, bounds = ids[alive].tolist(), np.cumsum(alive)[ends - 1].tolist()
    begin = 0
    for k, stop in enumerate(bounds):
        out.append(merge(tokens[k], ranks) if k in alone else kept[begin:stop])
        begin = stop
    return out


#: Where a text may be cut before it is split by the pattern: a space between two characters that
#: are neither white space nor control characters. No match of the pattern runs across it.
_CUT = re.compile(r"(?<=[^\s\x00-\x20\x7f-\xa0]) (?=[^\s\x00-\x20\x7f-\xa0])")
#: Characters next to which a space may be no such place, but for the line feed.
_ODD = re.compile("[\x00-\x09\x0b-\x1f\x7f-\xa0\u1680\u2000-\u200f\u2028\u2029\u202f\u205f\u3000]")

#: Number of ids, and the ids joined by spaces.
Entry = tuple[int, str]


class Codec:
    """encode(text) -> ids and decode(ids) -> bytes for a file of base64 tokens and ranks."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.tokens = {v: k for k, v in self.ranks.items()}
        self.names = {v: str(v) for v in self.tokens}
        self.named = {str(v): k for k, v in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.cut = pattern == _default_pattern()
        self.pairs = PairTable(self.ranks)
        self.pieces: dict[str, Entry] = {}  # each stands for itself with a space before it

    def encode(self, text: str) -> list[int]:
        return [int(x) for row in self.encoded([text]) for _, ids in row for x in ids.split()]

    def parts(self, text: str) -> list[str]:
        """Pieces of text that are split on their own; all but the first lack the space they begin with."""
        if not self.cut:
            return [text]
        if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or _ODD.search(text):
            return _CUT.split(text)
        return text.split(" ")

    def entry(self, ids: list[int]) -> Entry:
        names = self.names
        return len(ids), " ".join([names[i] for i in ids])

    def entries(self, tokens: set[str]) -> dict[str, Entry]:
        """Entries of pre-tokens."""
        ranks, names, out = self.ranks, self.names, {}
        odd: dict[str, bytes] = {}
        for token in tokens:
            raw = token.encode()
            rank = ranks.get(raw)
            if rank is not None:
                out[token] = (1, names[rank])
            elif len(raw) > 256:
                out[token] = self.entry(merge(raw, ranks))
            else:
                odd[token] = raw
        if len(odd) > FEW:
            for token, ids in zip(odd, merge_many(list(odd.values()), ranks, self.pairs), strict=True):
                out[token] = self.entry(ids)
        else:
            out.update((token, self.entry(merge(raw, ranks))) for token, raw in odd.items())
        return out

    def learn(self, pieces: set[str]) -> dict[str, Entry]:
        """Entries of pieces, by the pieces. A space goes before each."""
        words = {p for p in pieces if p.isalpha()}  # with its space such a piece is one pre-token
        rows = {p: self.split(" " + p) for p in pieces - words}
        known = self.entries({" " + p for p in words}.union(*rows.values()))
        out = {p: known[" " + p] for p in words}
        for p, row in rows.items():
            out[p] = self.joined([known[t] for t in row])
        return out

    @staticmethod
    def joined(row: list[Entry]) -> Entry:
        if len(row) == 1:
            return row[0]
        return sum([x[0] for x in row]), " ".join([x[1] for x in row])

    def encoded(self, texts: list[str]) -> Iterator[list[Entry]]:
        """The entries of each text's pieces, in order."""
        known, parts = self.pieces, self.parts
        new: set[str] = set()
        for text in texts:
            new.update(parts(text)[1:])
        new.difference_update(known)
        fresh = self.learn(new)
        known.update(fresh)
        heads = {parts(text)[0] if text else "" for text in texts}
        rows = {h: self.split(h) for h in heads}
        own = self.entries(set().union(*rows.values()))
        for text in texts:
            if text:
                row = parts(text)
                yield [*[own[t] for t in rows[row[0]]], *[known[p] for p in row[1:]]]
            else:
                yield []
        if len(known) > CACHE_PIECES:  # short pieces come again most often
            for p in fresh:
                if len(p) > CACHE_CHARS or len(known) > CACHE_PIECES * 2:
                    del known[p]
            if len(known) > CACHE_PIECES * 2:
                known.clear()

    def sections(self, text: str) -> Iterator[list[Entry]]:
        """The entries of a text of any length, a section at a time."""
        for part in _sections(text, GROUP_CHARS):
            yield from self.encoded([part])

    def decode(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])

    def decode_names(self, ids: list[str]) -> bytes:
        """The bytes of ids that are given in decimal."""
        return b"".join(map(self.named.__getitem__, ids))


@lru_cache(maxsize=1)
def _default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _groups(column: pa.Array) -> Iterator[list[str]]:
    """Texts of about GROUP_CHARS together; a longer one stands alone."""
    group, size = [], 0
    for value in column:
        text = value.as_py() or ""
        if group and size + len(text) > GROUP_CHARS:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def _sections(text: str, size: int) -> Iterator[str]:
    """Parts of about `size` characters of a long text, cut only where no match of the pattern runs across."""
    begin = 0
    while len(text) - begin > size:
        place = _CUT.search(text, begin + size)
        if place is None:
            break
        yield text[begin : place.start()]
        begin = place.start()
    yield text[begin:]


def bpe_roundtrip(docs: DataFrame, ranks: str, pattern: str, text: str = "text", ident: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row for each input row: identifier, n_tokens, ids_sha256, decoded_sha256, and ids with with_ids.

    ranks: path of the rank file, present on every executor. Texts are encoded whole, without
    special tokens (their strings are ordinary text), and the ids decoded again; null counts as
    empty (no ids). ids_sha256 is that of the decimal ids joined by one space. Rows are
    independent, so repeated rows and null identifiers pass through; other columns are dropped.
    """
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[ident]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gc

        gc.disable()  # millions of small tuples and no cycles
        tool = codec(ranks, pattern)
        for batch in batches:
            begin = 0
            for group in _groups(batch.column(1)):
                counts, ids_sha, text_sha, ids = [], [], [], []
                for rows in [[r] for r in tool.encoded(group)] if len(group) > 1 or not tool.cut else [tool.sections(group[0])]:
                    n, of_ids, of_text, own = 0, hashlib.sha256(), hashlib.sha256(), []
                    for done in rows:
                        more, numbers = tool.joined(done) if done else (0, "")
                        of_ids.update((" " * bool(n and more) + numbers).encode())
                        emitted = numbers.split()
                        of_text.update(tool.decode_names(emitted))
                        n += more
                        if with_ids:
                            own.append(np.array(emitted, np.int32))
                    counts.append(n)
                    ids_sha.append(of_ids.hexdigest())
                    text_sha.append(of_text.hexdigest())
                    if with_ids:
                        ids.append(np.concatenate(own))
                out = [batch.column(0).slice(begin, len(group)), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    out, names = [*out, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                begin += len(group)
                yield pa.RecordBatch.from_arrays(out, names=names)
        tool.pieces.clear()
        release()

    shape = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(docs[ident].alias("id"), docs[text].alias("text")).mapInArrow(run, shape).withColumnRenamed("id", ident)
