"""Bytes of CSV, XLSX and XLS files to grids of text. No Spark here."""

from __future__ import annotations

import csv
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

from ..functions.tokens import READER_NULLS
from .xls import read_sheets

Grid = list[list[str | None]]
_NULLS = frozenset(READER_NULLS)


class UnsupportedFormat(ValueError):
    """A file that no reader handles."""


def _cell(value: str | None) -> str | None:
    return None if value is None or value in _NULLS else value


def sniff_delimiter(line: str) -> str | None:
    """The delimiter of a line by the standard library's sniffer, None where it finds none."""
    try:
        return csv.Sniffer().sniff(line).delimiter
    except csv.Error:
        return None


def _grid(text: str, delimiter: str) -> Grid:
    lines = (line for line in io.StringIO(text, newline="") if line.strip())
    rows = list(csv.reader(lines, delimiter=delimiter, strict=True))
    if not rows:
        return []
    width = len(rows[0])
    for k, row in enumerate(rows):
        if len(row) > width:
            raise ValueError(f"row {k} has {len(row)} fields, the first has {width}")
    return [[_cell(v) for v in row] + [None] * (width - len(row)) for row in rows]


def parse_csv(raw: bytes) -> Grid:
    """UTF-8 text; blank lines are skipped, the delimiter is sniffed on the first line that is left.

    Where that delimiter, or none, doesn't parse, a comma is tried; a row wider than the first is
    an error then.
    """
    text = raw.decode("utf-8-sig")
    first = next((line for line in text.splitlines() if line.strip()), None)
    if first is None:
        return []
    delimiter = sniff_delimiter(first)
    if delimiter not in (None, ","):
        try:
            return _grid(text, delimiter)
        except (csv.Error, ValueError):
            pass
    return _grid(text, ",")


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Built-in number formats that show a date or a time.
_DATE_IDS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])


def _shows_date(code: str) -> bool:
    bare = re.sub(r'"[^"]*"|\\.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', "", code.lower())
    return bool(re.search(r"[ymdhs]", bare)) and "general" not in bare


def _column(ref: str) -> int:
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _number(raw: str, dated: bool, epoch: datetime) -> str:
    value = float(raw)
    if dated:
        return str(epoch + timedelta(seconds=round(value * 86400)))
    return str(int(value)) if value.is_integer() else repr(value)


def _text(node: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def parse_xlsx(raw: bytes) -> Iterator[tuple[str, Grid]]:
    """(name, grid) of every sheet in the workbook's order.

    Formulas give their stored value, errors are missing, whole numbers lose their fraction, and
    blank rows and cells at the end go; rows are as wide as the widest.
    """
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = set(z.namelist())
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        strings = []
        if "xl/sharedStrings.xml" in names:
            strings = [_text(si) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        dated: list[bool] = []
        if "xl/styles.xml" in names:
            styles = ElementTree.fromstring(z.read("xl/styles.xml"))
            custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(f"{_MAIN}numFmt")}
            for xf in styles.findall(f"{_MAIN}cellXfs/{_MAIN}xf"):
                k = int(xf.get("numFmtId", 0))
                dated.append(k in _DATE_IDS or (k in custom and _shows_date(custom[k])))
        props = book.find(f"{_MAIN}workbookPr")
        epoch = datetime(1904, 1, 1) if props is not None and props.get("date1904") in ("1", "true") else datetime(1899, 12, 30)
        for sheet in book.iter(f"{_MAIN}sheet"):
            target = links[sheet.get(_REL)]
            path = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join("xl", target))
            rows: dict[int, dict[int, str]] = {}
            at = -1
            for row in ElementTree.fromstring(z.read(path)).iter(f"{_MAIN}row"):
                at = int(row.get("r", at + 2)) - 1
                col = -1
                for c in row.iter(f"{_MAIN}c"):
                    col = _column(c.get("r")) if c.get("r") else col + 1
                    kind, v = c.get("t", "n"), c.find(f"{_MAIN}v")
                    raw_value = v.text if v is not None else None
                    if kind == "inlineStr":
                        value = _text(c)
                    elif raw_value is None or kind == "e":
                        value = None
                    elif kind == "s":
                        value = strings[int(raw_value)]
                    elif kind == "b":
                        value = "True" if raw_value == "1" else "False"
                    elif kind == "n":
                        style = int(c.get("s", 0))
                        value = _number(raw_value, style < len(dated) and dated[style], epoch)
                    else:
                        value = raw_value
                    if (value := _cell(value)) is not None:
                        rows.setdefault(at, {})[col] = value
            yield sheet.get("name"), _filled(rows)


def _filled(rows: dict[int, dict[int, str]]) -> Grid:
    """Values by row and column as a grid as wide as its widest row."""
    width = max((max(r) for r in rows.values()), default=-1) + 1
    return [[rows.get(k, {}).get(j) for j in range(width)] for k in range(max(rows, default=-1) + 1)]


def parse_xls(raw: bytes) -> Iterator[tuple[str, Grid]]:
    """The same of the older binary format (from Excel 97 on)."""
    for name, found in read_sheets(raw, _shows_date, _DATE_IDS):
        rows = {r: known for r, cells in found.items() if (known := {c: v for c, v in cells.items() if _cell(v) is not None})}
        yield name, _filled(rows)


def extension(path: str) -> str:
    return posixpath.splitext(posixpath.basename(path))[1].lower()


def parse_file(path: str, raw: bytes) -> Iterator[tuple[str, Grid]]:
    """(sheet, grid) of a CSV, XLSX or XLS file, told by its extension."""
    kind = extension(path)
    if kind == ".csv":
        yield "_default_", parse_csv(raw)
    elif kind == ".xlsx":
        yield from parse_xlsx(raw)
    elif kind == ".xls":
        yield from parse_xls(raw)
    else:
        raise UnsupportedFormat(f"{path}: no reader for {kind or 'a file without extension'}")
