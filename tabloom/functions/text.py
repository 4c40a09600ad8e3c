"""String expressions: stripping, missing values, names. All stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .tokens import CLEAN_NULLS, MASK_NULLS, NOT_WORD, SPACE

NAME_LENGTH, TABLE_NAME_LENGTH = 300, 1024


def strip(c: Column) -> Column:
    """Without white space (any in Unicode) at both ends. Most values have none, which two characters show."""
    c = c.cast("string")
    edge = F.left(c, F.lit(1)).rlike(SPACE) | F.right(c, F.lit(1)).rlike(SPACE)
    return F.when(edge, F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")).otherwise(c)


def is_blank(c: Column) -> Column:
    """Nothing but white space."""
    return c.rlike(f"^{SPACE}*$")


def null_tokens(c: Column) -> Column:
    """Null where the whole value is a word for a missing one, in any case."""
    return F.when(F.lower(c).isin(*CLEAN_NULLS), F.lit(None)).otherwise(c)


def has_content(c: Column) -> Column:
    """True where a cell counts as occupied."""
    return c.isNotNull() & ~is_blank(c) & ~c.isin(*MASK_NULLS)


def all_digits(c: Column) -> Column:
    return c.rlike(r"^\p{Nd}+$")


def sanitize_name(c: Column) -> Column:
    """A valid column or table name; null counts as the word None."""
    s = F.left(strip(F.coalesce(c.cast("string"), F.lit("None"))), F.lit(NAME_LENGTH))  # characters are replaced one by one, so only these count
    s = F.regexp_replace(s, NOT_WORD, "_")
    s = F.when(s == "", "_unnamed").when(s.rlike("^[A-Za-z_]"), s).otherwise(F.concat(F.lit("_"), s))
    return F.left(s, F.lit(NAME_LENGTH))


def file_extension(c: Column) -> Column:
    """Lower-case extension of a path's last part, with its dot; leading dots don't begin one."""
    base = F.regexp_extract(c, r"(?s)([^/]*)$", 1)
    return F.lower(F.regexp_extract(base, r"(?s)^\.*[^.].*?(\.[^.]*)$", 1))


def base_name(c: Column) -> Column:
    """A path's last part without its extension."""
    base = F.regexp_extract(c, r"(?s)([^/]*)$", 1)
    ext = F.regexp_extract(base, r"(?s)^\.*[^.].*?(\.[^.]*)$", 1)
    return F.left(base, F.length(base) - F.length(ext))


def table_name(path: Column, sheet: Column, table: Column, n_sheets: Column, n_tables: Column, default_sheet: str = "_default_") -> Column:
    """Target table of the table-th table of a sheet: file, sheet where it tells something, table where there are several."""
    with_sheet = (sheet != default_sheet) | (n_sheets > 1) | (n_tables > 1)
    name = F.concat_ws(
        "_", sanitize_name(base_name(path)), F.when(with_sheet, sanitize_name(sheet)), F.when(n_tables > 1, F.concat(F.lit("table_"), table.cast("string")))
    )
    return F.left(name, F.lit(TABLE_NAME_LENGTH))


# The same rules for the few names that the driver handles.

def clean_name(name: object) -> str:
    s = re.sub(r"[^\w]", "_", str(name).strip())
    if not s:
        return "_unnamed"
    return (s if re.match("[A-Za-z_]", s) else "_" + s)[:NAME_LENGTH]


def unique_names(names: list[str]) -> list[str]:
    """Names that differ also if case is ignored; the k-th repeat of a name gets _k, or the next free number."""
    out, used, repeats = [], set(), {}
    for name in names:
        new, k = name, repeats.get(name.lower(), 0)
        while new.lower() in used:
            k += 1
            new = name[: NAME_LENGTH - len(f"_{k}")] + f"_{k}"
        repeats[name.lower()] = k
        used.add(new.lower())
        out.append(new)
    return out


def generic_names(names: list[str]) -> bool:
    """Names that a reader made up: numbers, or `Unnamed: 3`."""
    return all(re.fullmatch(r"Unnamed: \d+|\d+", n) for n in names)
