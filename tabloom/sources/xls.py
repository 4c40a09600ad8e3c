"""Bytes of older binary Excel files (BIFF8 in a compound file) to grids of text. No Spark here.

Only what grids need is read: sheets, values, stored formula results, and which number formats
show dates.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from datetime import datetime, timedelta

_MAGIC = bytes.fromhex("d0cf11e0a1b11ae1")
_END = 0xFFFFFFFA  # sector numbers from here on end a chain
# Record types.
_BOF, _EOF, _CONTINUE, _SST, _SHEET, _FORMAT, _XF, _EPOCH, _PASSWORD = 0x809, 0x0A, 0x3C, 0xFC, 0x85, 0x41E, 0xE0, 0x22, 0x2F
_LABEL_SST, _NUMBER, _RK, _MULTI_RK, _LABEL, _RICH, _FORMULA, _STRING, _BOOL = 0xFD, 0x203, 0x27E, 0xBD, 0x204, 0xD6, 0x06, 0x207, 0x205


class BrokenWorkbook(ValueError):
    """Bytes that are no workbook this module can read."""


def workbook_stream(raw: bytes) -> bytes:
    """The stream Workbook of a compound file."""
    if raw[:8] != _MAGIC:
        raise BrokenWorkbook("not a compound file")
    shift, small_shift = struct.unpack_from("<HH", raw, 0x1E)
    n_fat, first_dir, limit, first_small, _, first_extra, n_extra = (struct.unpack_from("<I", raw, at)[0] for at in (0x2C, 0x30, 0x38, 0x3C, 0x40, 0x44, 0x48))
    size, per = 1 << shift, (1 << shift) // 4

    def sector(k: int) -> bytes:
        return raw[(k + 1) * size : (k + 2) * size]

    where = list(struct.unpack_from("<109I", raw, 0x4C))
    for _ in range(n_extra):
        block = struct.unpack(f"<{per}I", sector(first_extra))
        where += block[:-1]
        first_extra = block[-1]
    fat = [x for k in where[:n_fat] for x in struct.unpack(f"<{per}I", sector(k))]

    def chain(k: int, table: list[int]) -> Iterator[int]:
        for _ in range(len(table) + 1):
            if k >= _END:
                return
            yield k
            k = table[k]
        raise BrokenWorkbook("a chain of sectors has no end")

    names = b"".join(map(sector, chain(first_dir, fat)))
    root, found = None, None
    for at in range(0, len(names), 128):
        entry = names[at : at + 128]
        n = struct.unpack_from("<H", entry, 0x40)[0]
        name = entry[: max(0, n - 2)].decode("utf-16-le", "replace")
        place = struct.unpack_from("<II", entry, 0x74)
        if entry[0x42] == 5:
            root = place
        elif entry[0x42] == 2 and name.lower() == "workbook":
            found = place
    if found is None or root is None:
        raise BrokenWorkbook("no Workbook stream; Excel files before 1997 aren't read")
    if found[1] >= limit:
        return b"".join(map(sector, chain(found[0], fat)))[: found[1]]
    body = b"".join(map(sector, chain(root[0], fat)))
    table = [x for k in chain(first_small, fat) for x in struct.unpack(f"<{per}I", sector(k))]
    small = 1 << small_shift
    return b"".join(body[k * small : (k + 1) * small] for k in chain(found[0], table))[: found[1]]


def _records(data: bytes, at: int) -> Iterator[tuple[int, bytes]]:
    while at + 4 <= len(data):
        kind, n = struct.unpack_from("<HH", data, at)
        yield kind, data[at + 4 : at + 4 + n]
        at += 4 + n


class _Cursor:
    """Reads on over the pieces of a record and its continuations."""

    def __init__(self, pieces: list[bytes]):
        self.pieces, self.k, self.at = pieces, 0, 0

    def take(self, n: int) -> bytes:
        out = b""
        while n and self.k < len(self.pieces):
            part = self.pieces[self.k][self.at : self.at + n]
            out, n, self.at = out + part, n - len(part), self.at + len(part)
            if n:
                self.k, self.at = self.k + 1, 0
        return out

    def text(self, n: int) -> str:
        """A string of n characters from its flags on. A continuation begins with the flags again."""
        flags = self.take(1)[0]
        runs = struct.unpack("<H", self.take(2))[0] if flags & 8 else 0
        extra = struct.unpack("<I", self.take(4))[0] if flags & 4 else 0
        out = []
        while n:
            if self.k < len(self.pieces) and self.at >= len(self.pieces[self.k]):
                self.k, self.at = self.k + 1, 0
                flags = self.take(1)[0]
            if self.k >= len(self.pieces):
                raise BrokenWorkbook("a string is cut off")
            wide = 1 + (flags & 1)
            m = min(n, (len(self.pieces[self.k]) - self.at) // wide)
            if not m:
                raise BrokenWorkbook("a string is cut off")
            out.append(self.take(m * wide).decode("utf-16-le" if wide == 2 else "latin-1"))
            n -= m
        self.take(4 * runs + extra)
        return "".join(out)


def _rk(raw: bytes) -> float:
    n = struct.unpack("<i", raw)[0]
    value = float(n >> 2) if n & 2 else struct.unpack("<d", b"\0\0\0\0" + struct.pack("<I", n & 0xFFFFFFFC))[0]
    return value / 100 if n & 1 else value


def read_sheets(raw: bytes, shows_date, date_ids: frozenset[int]) -> Iterator[tuple[str, dict[int, dict[int, str]]]]:
    """(name, values by row and column) of each worksheet, in the workbook's order.

    shows_date: whether a custom number format is one of dates; date_ids: the built-in ones that are.
    """
    data = workbook_stream(raw)
    sheets, formats, of_style, strings, epoch = [], {}, [], [], datetime(1899, 12, 30)
    shared: list[bytes] | None = None
    for kind, body in _records(data, 0):
        if kind == _CONTINUE and shared is not None:
            shared.append(body)
            continue
        if shared is not None:
            cursor = _Cursor(shared)
            count = struct.unpack("<II", cursor.take(8))[1]
            strings = [cursor.text(struct.unpack("<H", cursor.take(2))[0]) for _ in range(count)]
            shared = None
        if kind == _BOF and struct.unpack_from("<H", body)[0] != 0x600:
            raise BrokenWorkbook("Excel files before 1997 aren't read")
        if kind == _PASSWORD:
            raise BrokenWorkbook("the workbook has a password")
        if kind == _SST:
            shared = [body]
        elif kind == _SHEET:
            sheets.append((_Cursor([body[7:]]).text(body[6]), struct.unpack_from("<I", body)[0], body[5]))
        elif kind == _FORMAT:
            formats[struct.unpack_from("<H", body)[0]] = _Cursor([body[4:]]).text(struct.unpack_from("<H", body, 2)[0])
        elif kind == _XF:
            of_style.append(struct.unpack_from("<H", body, 2)[0])
        elif kind == _EPOCH and struct.unpack_from("<H", body)[0]:
            epoch = datetime(1904, 1, 1)
        elif kind == _EOF:
            break

    def number(value: float, style: int) -> str:
        k = of_style[style] if style < len(of_style) else 0
        if k in date_ids or (k in formats and shows_date(formats[k])):
            return str(epoch + timedelta(seconds=round(value * 86400)))
        return str(int(value)) if value.is_integer() else repr(value)

    for name, at, sort in sheets:
        if sort:  # charts and macros
            continue
        rows: dict[int, dict[int, str]] = {}
        depth, waiting = 0, None
        for kind, body in _records(data, at):
            if kind == _BOF:
                depth += 1
            elif kind == _EOF:
                depth -= 1
                if not depth:
                    break
            if depth != 1 or len(body) < 4:
                continue
            row, col = struct.unpack_from("<HH", body)
            value = None
            if kind == _LABEL_SST:
                value = strings[struct.unpack_from("<I", body, 6)[0]]
            elif kind == _NUMBER:
                value = number(struct.unpack_from("<d", body, 6)[0], struct.unpack_from("<H", body, 4)[0])
            elif kind == _RK:
                value = number(_rk(body[6:10]), struct.unpack_from("<H", body, 4)[0])
            elif kind == _MULTI_RK:
                for k in range((len(body) - 6) // 6):
                    style, rk = struct.unpack_from("<H", body, 4 + 6 * k)[0], body[6 + 6 * k : 10 + 6 * k]
                    rows.setdefault(row, {})[col + k] = number(_rk(rk), style)
            elif kind in (_LABEL, _RICH):
                value = _Cursor([body[8:]]).text(struct.unpack_from("<H", body, 6)[0])
            elif kind == _BOOL and not body[7]:
                value = "True" if body[6] else "False"
            elif kind == _FORMULA:
                result = body[6:14]
                if result[6:] != b"\xff\xff":
                    value = number(struct.unpack("<d", result)[0], struct.unpack_from("<H", body, 4)[0])
                elif result[0] == 0:
                    waiting = (row, col)  # the text follows in a record of its own
                elif result[0] == 1:
                    value = "True" if result[2] else "False"
            elif kind == _STRING and waiting:
                (row, col), waiting = waiting, None
                value = _Cursor([body[2:]]).text(struct.unpack_from("<H", body)[0])
            if value is not None:
                rows.setdefault(row, {})[col] = value
        yield name, rows
