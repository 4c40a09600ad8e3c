"""External suffix sorting by induction: arrays, sorts and queues go to disk beyond a bound of memory.

The text is a run of byte strings, each followed by a sentinel. Suffixes are of type S or L, as
they sort before or after their right neighbour; the leftmost of each run of S suffixes (S*)
are sorted first, by the names of the stretches between them. From these, all L suffixes are
induced in one pass from the smallest first byte up, and all S suffixes from the largest down:
each suffix that is taken puts its left neighbour into the queue of that neighbour's first byte.
As a pass only ever takes from the lowest (highest) queue that is left, the queues together are a
priority queue, appended and read in blocks. Its tuples hold a suffix and the length of the
prefix that it shares with the tuple before it in its queue: one more than the least of these
lengths among the suffixes taken in between, which a table of range minima gives for a block at
once.

Everything that grows with the text is read and written in blocks: the text, the types and the
ranks are arrays that move to files when memory is short (Space), the S* suffixes are sorted by
runs on disk that are merged, a queue that outgrows its share is moved to a file, and the sorted
suffixes leave as a stream, largest first. So a text may be far larger than memory.

The order of the S* suffixes themselves comes from doubling ranks over their names rather than
from a further level of queues, whose symbols would be as many as the names.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes of memory for arrays, sorts and queues together, about.
MEMORY_BYTES = 128 << 20
#: Entries that are handled at once, at most.
BLOCK = 1 << 18
#: Symbols of a stretch in its first sort key, and in each of the next ones, which stand beside a rank.
_PACK, _MORE = 6, 3
_MOST = np.int32(1 << 15)  # longer than any prefix that is told


class Space:
    """Arrays in memory, up to a bound for all of them together, and in temporary files beyond."""

    def __init__(self, most: int = MEMORY_BYTES):
        self.sorting = self.queues = most // 4
        self.left = most // 2
        self.block = int(min(BLOCK, max(16, most // 256)))
        self.on_disk = 0

    def array(self, n: int, kind) -> np.ndarray:
        size = n * np.dtype(kind).itemsize
        if size <= self.left:
            self.left -= size
            return np.zeros(n, kind)
        f = tempfile.TemporaryFile()
        f.truncate(size)
        self.on_disk += 1
        return np.memmap(f, kind, "r+", shape=(n,))

    def free(self, a: np.ndarray) -> None:
        if not isinstance(a, np.memmap):
            self.left += a.nbytes

    def blocks(self, n: int, backwards: bool = False) -> Iterator[tuple[int, int]]:
        starts = range(0, n, self.block)
        for a in reversed(starts) if backwards else starts:
            yield a, min(n, a + self.block)


class Queues:
    """One first-in-first-out queue of tuples (suffix << 16 | shared prefix) for each symbol; the largest goes to disk when memory is short."""

    def __init__(self, symbols: int, most: int, block: int):
        self.held: list[list[np.ndarray]] = [[] for _ in range(symbols)]
        self.bytes, self.most, self.block = [0] * symbols, most, block
        self.total, self.file, self.end = 0, None, 0
        self.parts: list[list[list[int]]] = [[] for _ in range(symbols)]  # first and last entry (exclusive) in the file; earlier than what is held

    def put(self, symbol: int, entries: np.ndarray) -> None:
        self.held[symbol].append(entries)
        self.bytes[symbol] += entries.nbytes
        self.total += entries.nbytes
        while self.total > self.most:
            big = max(range(len(self.bytes)), key=self.bytes.__getitem__)
            n = self.bytes[big] // 8
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(8 * self.end)
            for part in self.held[big]:
                self.file.write(part.astype(np.int64, copy=False).tobytes())
            self.parts[big].append([self.end, self.end + n])
            self.end += n
            self.total -= self.bytes[big]
            self.held[big], self.bytes[big] = [], 0

    def _read(self, a: int, b: int) -> np.ndarray:
        self.file.seek(8 * a)
        return np.frombuffer(self.file.read(8 * (b - a)), np.int64)

    def take(self, symbol: int) -> np.ndarray:
        """The next entries of a queue, at most a block of them; none when it is empty."""
        if self.parts[symbol]:
            part = self.parts[symbol][0]
            a = part[0]
            part[0] = min(part[1], a + self.block)
            if part[0] == part[1]:
                self.parts[symbol].pop(0)
            return self._read(a, part[0])
        parts = self.held[symbol]
        out, n = [], 0
        while parts and n < self.block:
            part = parts[0][: self.block - n]
            if len(part) == len(parts[0]):
                parts.pop(0)
            else:
                parts[0] = parts[0][len(part) :]
            out.append(part)
            n += len(part)
        self.bytes[symbol] -= 8 * n
        self.total -= 8 * n
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def last(self, symbol: int) -> int | None:
        """The suffix that was put last."""
        if self.held[symbol]:
            return int(self.held[symbol][-1][-1]) >> 16
        if self.parts[symbol]:
            end = self.parts[symbol][-1][1]
            return int(self._read(end - 1, end)[0]) >> 16
        return None

    def backwards(self, symbol: int) -> Iterator[np.ndarray]:
        """All entries, the last first, in blocks; the queue is empty then."""
        parts, self.held[symbol] = self.held[symbol], []
        self.total -= self.bytes[symbol]
        self.bytes[symbol] = 0
        while parts:
            part = parts.pop()[::-1]
            for a in range(0, len(part), self.block):
                yield part[a : a + self.block]
        while self.parts[symbol]:
            a, b = self.parts[symbol].pop()
            while b > a:
                c = max(a, b - self.block)
                yield self._read(c, b)[::-1]
                b = c


def sorted_stream(pairs: Iterable[tuple[np.ndarray, np.ndarray]], space: Space) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (keys, values) in order of the keys, from blocks in any order: runs are sorted in memory, kept on disk and merged."""
    runs, held, size, file, end = [], [], 0, None, 0  # a run: its place in the file, what is read of it, its length

    def run() -> tuple[np.ndarray, np.ndarray]:
        keys, values = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(keys)
        return keys[order], values[order]

    def write() -> None:
        nonlocal file, end
        file = file or tempfile.TemporaryFile()
        keys, values = run()
        file.seek(8 * end)
        file.write(keys.tobytes())
        file.write(values.tobytes())
        runs.append([end, 0, len(keys)])
        end += 2 * len(keys)
        space.on_disk += 1

    for keys, values in pairs:
        held.append((keys, values))
        size += 32 * len(keys)
        if size > space.sorting:
            write()
            held, size = [], 0
    if not runs:
        if held:
            keys, values = run()
            for a, b in space.blocks(len(keys)):
                yield keys[a:b], values[a:b]
        return
    if held:
        write()
        held = []
    most = max(4, space.sorting // (48 * len(runs)))

    def part(place: int, at: int, n: int, column: int) -> np.ndarray:
        file.seek(8 * (place + column * n + at))
        return np.frombuffer(file.read(8 * min(most, n - at)), np.int64)

    while runs:
        heads = [(part(*r, 0), part(*r, 1)) for r in runs]
        # Up to the least of the last keys at hand, all that is there is known.
        bound = min(int(k[-1]) for k, _ in heads)
        cut = [int(np.searchsorted(k, bound, "right")) for k, _ in heads]
        keys = np.concatenate([k[:c] for (k, _), c in zip(heads, cut, strict=True)])
        values = np.concatenate([v[:c] for (_, v), c in zip(heads, cut, strict=True)])
        order = np.argsort(keys, kind="stable")
        yield keys[order], values[order]
        for r, c in zip(runs, cut, strict=True):
            r[1] += c
        runs = [r for r in runs if r[1] < r[2]]
    file.close()


class Text:
    """Strings end to end: symbols are bytes plus one, with a 0 after each string. Filled with add(), then closed."""

    def __init__(self, size: int, space: Space):
        self.space, self.n = space, 0
        self.raw = space.array(size + 8, np.uint8)  # eight more, so that words can be read anywhere
        self.symbols = space.array(size, np.int16)
        self.ends: list[int] | np.ndarray = []

    def add(self, string: bytes) -> None:
        a, b = self.n, self.n + len(string)
        self.raw[a:b] = np.frombuffer(string, np.uint8)
        self.symbols[a:b] = self.raw[a:b]
        self.symbols[a:b] += 1
        self.ends.append(b)
        self.n = b + 1

    def close(self) -> None:
        self.ends = np.array(self.ends, np.int64)
        self.words = np.ndarray((self.n,), "<u8", buffer=self.raw, strides=(1,))  # the first byte in the lowest bits

    def room(self, at: np.ndarray) -> np.ndarray:
        """Symbols up to the end of the string."""
        return self.ends[np.searchsorted(self.ends, at)] - at

    def alike(self, at: int, most: int) -> int:
        """How long the symbol at a place goes on, up to most."""
        part = self.symbols[at : at + most]
        differ = np.flatnonzero(part != part[0])
        return int(differ[0]) if len(differ) else len(part)


def _types(text: Text) -> np.ndarray:
    """True where the suffix is of type S. A sentinel is S."""
    s = text.space.array(text.n, bool)
    after, kind = 0, True  # symbol and type of what follows the block
    for a, b in text.space.blocks(text.n, backwards=True):
        t = np.asarray(text.symbols[a : b + 1] if b < text.n else np.append(text.symbols[a:b], np.int16(after)))
        here, following = t[:-1], t[1:]
        change = here != following
        # Where a symbol repeats, the type is that of the next place where it changes.
        where = np.where(change, np.arange(b - a), b - a)
        where = np.minimum.accumulate(where[::-1])[::-1]
        less = np.append(here < following, kind)
        own = less[where]
        own[here == 0] = True
        s[a:b] = own
        kind = bool(own[0])
    return s


def _rerank(stream: Iterator[tuple[np.ndarray, np.ndarray]], rank: np.ndarray, tied: np.ndarray, shift: int) -> None:
    """New ranks from (old rank << shift | key, S* suffix) in order: the place at which a group of equals begins.

    With shift 0 all suffixes are there, and a rank is the place among them; else it is counted from
    the old rank, which is that of a group whose members are all there.
    """
    at, last, last_one, group, begin, first = 0, None, 0, None, 0, 0
    for keys, ones in stream:
        place = np.arange(at, at + len(keys))
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        new[0] = last is None or int(keys[0]) != last
        starts = np.maximum.accumulate(np.where(new, place, first))
        same = ~new
        tied[ones] = same | np.append(same[1:], False)
        if same[0]:
            tied[last_one] = True
        if shift:
            old = keys >> shift
            fresh = np.ones(len(keys), bool)
            fresh[1:] = old[1:] != old[:-1]
            fresh[0] = group is None or int(old[0]) != group
            begins = np.maximum.accumulate(np.where(fresh, place, begin))
            rank[ones] = old + starts - begins
            group, begin = int(old[-1]), int(begins[-1])
        else:
            rank[ones] = starts
        at, last, last_one, first = at + len(keys), int(keys[-1]), int(ones[-1]), int(starts[-1])


class Stars:
    """S* suffixes in order of the text, and sorted by at least their first `depth` symbols."""

    def __init__(self, text: Text, s: np.ndarray, depth: int):
        self.text, self.depth, space = text, depth, text.space
        n = 0
        for a, b in space.blocks(text.n):
            n += int(np.count_nonzero(self._marks(s, a, b)))
        self.n, self.at = n, space.array(n, np.int64)
        k = 0
        for a, b in space.blocks(text.n):
            found = np.flatnonzero(self._marks(s, a, b)) + a
            self.at[k : k + len(found)] = found
            k += len(found)
        rank, tied = space.array(n, np.int64), space.array(n, bool)
        self._names(s, rank, tied)
        self._double(rank, tied)
        # Suffixes that share all of their first symbols come in any order.
        self.order = space.array(n, np.int64)
        k = 0
        for _, ones in sorted_stream(((np.array(rank[a:b]), np.arange(a, b)) for a, b in space.blocks(n)), space):
            self.order[k : k + len(ones)] = ones
            rank[ones] = np.arange(k, k + len(ones))
            k += len(ones)
        self.place = rank
        space.free(tied)
        self.shared = self._share()

    @staticmethod
    def _marks(s: np.ndarray, a: int, b: int) -> np.ndarray:
        before = np.append(True if a == 0 else s[a - 1], s[a : b - 1])
        return s[a:b] & ~before

    def _key(self, s: np.ndarray, ones: np.ndarray, begin: int, count: int) -> np.ndarray:
        """Symbols and types from `begin` on of each stretch, which reaches to the next S* suffix, inclusive; zero beyond it."""
        n, start = self.text.n, self.at[ones]
        end = np.where(ones + 1 < self.n, self.at[np.minimum(ones + 1, self.n - 1)], n - 1)
        out = np.zeros(len(ones), np.int64)
        for k in range(begin, begin + count):
            place = np.minimum(start + k, n - 1)
            symbol = (self.text.symbols[place].astype(np.int64) << 1 | s[place]) + 1
            out = out << 10 | np.where(start + k <= end, symbol, 0)
        return out

    def _tied(self, tied: np.ndarray) -> Iterator[np.ndarray]:
        for a, b in self.text.space.blocks(self.n):
            found = np.flatnonzero(tied[a:b]) + a
            if len(found):
                yield found

    def _longer(self, ones: np.ndarray, than: int) -> np.ndarray:
        end = np.where(ones + 1 < self.n, self.at[np.minimum(ones + 1, self.n - 1)], self.text.n - 1)
        return ones[end - self.at[ones] + 1 > than]

    def _names(self, s: np.ndarray, rank: np.ndarray, tied: np.ndarray) -> None:
        """Ranks by the stretches between S* suffixes, up to `depth` symbols of each."""
        space = self.text.space
        _rerank(sorted_stream(((self._key(s, np.arange(a, b), 0, _PACK), np.arange(a, b)) for a, b in space.blocks(self.n)), space), rank, tied, 0)
        done = _PACK
        while done < self.depth:
            more = (self._longer(x, done) for x in self._tied(tied))
            pairs = ((rank[x] << 10 * _MORE | self._key(s, x, done, _MORE), x) for x in more if len(x))
            first = next(pairs, None)
            if first is None:
                break
            _rerank(sorted_stream(_chain(first, pairs), space), rank, tied, 10 * _MORE)
            done += _MORE

    def _double(self, rank: np.ndarray, tied: np.ndarray) -> None:
        """Ranks by 1, 2, 4 ... names, until all differ or as many names hold `depth` symbols. A string's end is followed by nothing."""
        step, space = 1, self.text.space
        while step <= self.depth:
            old = space.array(self.n, np.int64)
            for a, b in space.blocks(self.n):
                old[a:b] = rank[a:b]

            def keys(x: np.ndarray, step=step, old=old) -> np.ndarray:
                beyond = x + step
                return old[x] << 31 | np.where(beyond < self.n, old[np.minimum(beyond, self.n - 1)] + 1, 0)

            more = (x[self.text.symbols[self.at[x]] != 0] for x in self._tied(tied))
            pairs = ((keys(x), x) for x in more if len(x))
            first = next(pairs, None)
            if first is not None:
                _rerank(sorted_stream(_chain(first, pairs), space), rank, tied, 31)
            space.free(old)
            if first is None:
                break
            step *= 2

    def _share(self) -> np.ndarray:
        """Symbols that each of the sorted suffixes shares with the one before it, up to `depth`.

        A suffix that stands d symbols after one that shares l with its neighbour shares at least
        l - d with its own, if the neighbour's suffix d further on is an S* suffix too and comes
        earlier. So a few suffixes are compared from their start, and the others from where that leaves off.
        """
        space, n = self.text.space, self.n
        out = space.array(n, np.int32)
        for level, step in enumerate(_STEPS):
            carry = -1
            for a, b in space.blocks(n):
                ones, at = np.arange(a, b), self.at[a:b]
                before = np.append(-1 if a == 0 else self.at[a - 1], at[:-1])
                fresh = (before < 0) | (self.text.room(np.maximum(before, 0)) + before < at)  # the first of a string
                rough = [(ones % x == 0) | (fresh if x == _STEPS[0] else False) for x in _STEPS[: level + 1]]
                known = np.logical_or.reduce(rough[:-1]) if level else np.zeros(b - a, bool)
                last = np.maximum.accumulate(np.where(known, ones, carry))
                carry = int(last[-1])
                todo = np.flatnonzero(rough[-1] & ~known)
                place = self.place[ones[todo]]
                todo, place = todo[place > 0], place[place > 0]
                base, here = last[todo], np.array(at[todo])
                has = base >= 0
                base = np.maximum(base, 0)
                shift, rank = here - self.at[base], self.place[base]
                has &= rank > 0
                there = self.at[self.order[np.maximum(rank - 1, 0)]] + shift
                spot = np.minimum(np.searchsorted(self.at, there), n - 1)
                has &= (self.at[spot] == there) & (self.place[spot] < place)
                least = np.where(has, np.maximum(out[rank] - shift, 0), 0)
                out[place] = common_prefixes(self.text, self.at[self.order[place - 1]], here, self.depth, least)
        return out

    def sorted_blocks(self, a: int, b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for x in range(a, b, self.text.space.block):
            y = min(b, x + self.text.space.block)
            yield self.at[self.order[x:y]], np.array(self.shared[x:y])


#: Steps between the S* suffixes, in order of the text, whose shared prefixes are found first, next, ...
_STEPS = (64, 16, 4, 1)


def _chain(first, rest):
    yield first
    yield from rest


def common_prefixes(text: Text, x: np.ndarray, y: np.ndarray, most: int, least: np.ndarray) -> np.ndarray:
    """Symbols that the suffixes x and y share, up to `most` and a string's end, given that they share `least`."""
    out = np.minimum(np.minimum(text.room(x), text.room(y)), most).astype(np.int32)
    left = np.flatnonzero(out > least)
    at = least[left].astype(np.int64)
    a, b = x[left] + at, y[left] + at
    while len(left):
        differ = text.words[a] ^ text.words[b]
        some = differ != 0
        hit, bits = left[some], differ[some]
        bits &= ~bits + np.uint64(1)  # the lowest bit that is set
        out[hit] = np.minimum(out[hit], at[some] + (np.frexp(bits.astype(np.float64))[1] - 1) // 8)
        more = ~some & (out[left] > at + 8)
        left, a, b, at = left[more], a[more] + 8, b[more] + 8, at[more] + 8
    return out


class RangeMin:
    """Least of values[a..b], inclusive, for many ranges at once."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        width = 1
        while width * 2 <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), self.levels[0].dtype)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            table = self.levels[k]
            out[at] = np.minimum(table[a[at]], table[b[at] - (1 << k) + 1])
        return out


class Pass:
    """One pass of induction: queues, and for each the least prefix shared since something was put into it."""

    def __init__(self, text: Text, s: np.ndarray, want_s: bool, depth: int):
        self.t, self.s, self.want, self.depth = text.symbols, s, want_s, depth
        self.queues = Queues(257, text.space.queues, text.space.block)
        self.since = np.zeros(257, np.int32)
        self.begun = np.zeros(257, bool)

    def enter(self) -> None:
        """A new first symbol: what follows shares nothing with what came before."""
        self.since[:] = 0

    def own(self, symbol: int) -> Iterator[np.ndarray]:
        """The tuples of a symbol's queue in blocks, also those that are put there meanwhile; each is scanned."""
        fresh = True
        while len(both := self.queues.take(symbol)):
            both = both.copy()
            if fresh:
                both[0] &= ~0xFFFF  # the first shares nothing with what came before
                fresh = False
            self.scan(both >> 16, (both & 0xFFFF).astype(np.int32))
            yield both

    def scan(self, batch: np.ndarray, shared: np.ndarray) -> None:
        """Puts the left neighbours of a batch into their queues."""
        at = np.flatnonzero(batch > 0)
        left = batch[at] - 1
        keep = (self.s[left] == self.want) & (self.t[left] != 0)
        at, left = at[keep], left[keep]
        c = np.asarray(self.t[left])
        order = np.argsort(c, kind="stable")
        at, left, c = at[order], left[order], c[order]
        least = np.minimum(self.since, shared.min())
        if len(at):
            new = np.concatenate([[True], c[1:] != c[:-1]])
            ranges = RangeMin(shared)
            value = ranges.of(np.where(new, 0, np.concatenate([[0], at[:-1] + 1])), at)
            value[new] = np.minimum(value[new], self.since[c[new]])
            value = np.minimum(value + 1, self.depth)
            value[new & ~self.begun[c]] = 0
            bounds = [*np.flatnonzero(new).tolist(), len(at)]
            tuples = left << 16 | value
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                d, last = int(c[a]), int(at[b - 1])
                self.begun[d] = True
                least[d] = shared[last + 1 :].min() if last + 1 < len(shared) else _MOST
                self.queues.put(d, tuples[a:b])
        self.since = least


def suffixes(text: Text, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (suffixes, symbols that each shares with the one before it in this stream, up to depth), the largest suffix first.

    Suffixes are in order of their first `depth` symbols; those that start at a 0 are left out, and
    shared prefixes never reach past a string's end.
    """
    space = text.space
    s = _types(text)
    stars = Stars(text, s, depth)
    counts = np.zeros(257, np.int64)
    for a, b in space.blocks(stars.n):
        counts += np.bincount(text.symbols[stars.at[a:b]], minlength=257)
    cuts = np.concatenate([[0], np.cumsum(counts)])

    def meet(a: int | None, b: int | None) -> int:
        """What an L suffix shares with an S suffix of the same first symbol."""
        return min(text.alike(a, depth), text.alike(b, depth), depth) if a is not None and b is not None else 0

    # L suffixes, ascending. The ends come first.
    up, large = Pass(text, s, False, depth), Queues(257, space.queues, space.block)
    for a in range(0, len(text.ends), space.block):
        ends = text.ends[a : a + space.block]
        up.scan(ends, np.zeros(len(ends), np.int32))
    for symbol in range(1, 257):
        up.enter()
        for both in up.own(symbol):
            large.put(symbol, both)
        first = True
        for batch, shared in stars.sorted_blocks(cuts[symbol], cuts[symbol + 1]):
            if first:
                shared[0] = meet(large.last(symbol), int(batch[0]))
                first = False
            up.scan(batch, shared)

    # S suffixes, descending; within a symbol they come after the L suffixes, and so first here.
    down = Pass(text, s, True, depth)
    for symbol in range(256, 0, -1):
        down.enter()
        last = None
        for both in down.own(symbol):
            yield both >> 16, (both & 0xFFFF).astype(np.int32)
            last = int(both[-1]) >> 16
        carry = meet(large.last(symbol), last)
        for both in large.backwards(symbol):
            own = (both & 0xFFFF).astype(np.int32)
            shared = np.concatenate([[np.int32(carry)], own[:-1]]).astype(np.int32)
            carry = int(own[-1])
            down.scan(both >> 16, shared)
            yield both >> 16, shared


def repeated_starts(
    strings: Iterable[bytes], depth: int, starts: np.ndarray | list[int], often: np.ndarray, memory: int = MEMORY_BYTES, short: int | None = None,
    owners: np.ndarray | None = None, spread: np.ndarray | None = None, size: int | None = None, space: Space | None = None,
) -> Iterator[np.ndarray]:
    """For each string, which of its first starts[k] places begin a stretch of `depth` bytes that begins elsewhere too.

    Places from starts[k] on are left out altogether. often[k]: the string stands for several
    equal ones, so each of its places with room for a stretch begins a repeated one. With short,
    the results are 1 for that, plus 2 where a stretch of `short` bytes (at most depth) also begins in a string
    of another owner; spread[k]: the string stands for equal ones of several owners. size: bytes of
    all strings together, needed where they come from an iterator.
    """
    space = space or Space(memory)
    if size is None:
        strings = list(strings)
        size = sum(map(len, strings))
    counts = np.asarray(starts, np.int64)
    if not len(counts):
        return
    text = Text(size + len(counts), space)
    for x in strings:
        text.add(x)
    text.close()
    begin = np.concatenate([[0], text.ends[:-1] + 1])
    hit = space.array(text.n, np.int8)
    for k in np.flatnonzero(often).tolist():
        hit[begin[k] : begin[k] + max(0, min(int(counts[k]), int(text.ends[k] - begin[k]) - depth + 1))] = 1
    total = int(counts.sum())
    kept, group, several = (space.array(total if short else 0, x) for x in (np.int64, np.int64, bool))
    n, name, before, least, low, high, any_spread = 0, -1, -1, _MOST, 0, 0, False
    for order, shared in suffixes(text, depth):
        owner = np.searchsorted(begin, order, "right") - 1
        own = np.flatnonzero(order - begin[owner] < counts[owner])
        if not len(own):
            least = min(least, int(shared.min()))
            continue
        # What a place shares with the last one that counts: the least of all in between.
        common = np.minimum.reduceat(shared[: own[-1] + 1], np.concatenate([[0], own[:-1] + 1]))
        common[0] = min(int(common[0]), int(least))
        least = shared[own[-1] + 1 :].min() if own[-1] + 1 < len(shared) else _MOST
        order, owner = order[own], owner[own]
        same = common >= depth
        same[0] &= before >= 0
        hit[order[same]] |= 1
        hit[np.append(before, order[:-1])[same]] |= 1
        before = int(order[-1])
        if not short:
            continue
        new = common < short
        new[0] |= name < 0
        names = name + np.cumsum(new)
        kept[n : n + len(order)], group[n : n + len(order)] = order, names
        n += len(order)
        who, some = owners[owner], spread[owner]
        first = np.flatnonzero(new)
        first = first if new[0] else np.concatenate([[0], first])
        lows, highs, flags = np.minimum.reduceat(who, first), np.maximum.reduceat(who, first), np.logical_or.reduceat(some, first)
        if not new[0]:
            lows[0], highs[0], flags[0] = min(int(lows[0]), low), max(int(highs[0]), high), flags[0] | any_spread
        several[names[first]] = (lows != highs) | flags
        name, low, high, any_spread = int(names[-1]), int(lows[-1]), int(highs[-1]), bool(flags[-1])
    if short:
        for a, b in space.blocks(n):
            hit[kept[a:b][several[group[a:b]]]] |= 2
    for b, c in zip(begin.tolist(), counts.tolist(), strict=True):
        yield np.array(hit[b : b + c]) if short else hit[b : b + c].astype(bool)
