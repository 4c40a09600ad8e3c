"""Parsing of text into numbers, truth values, dates and times. A value that doesn't parse gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip
from .tokens import FALSE_WORDS, INFINITE, NUMBER, TRUE_WORDS


def stripped_is_number(s: Column) -> Column:
    return s.rlike(NUMBER) | s.rlike(INFINITE)


def is_number(c: Column) -> Column:
    return stripped_is_number(strip(c))


def to_double(c: Column) -> Column:
    return F.when(is_number(c), strip(c).try_cast("double"))


def whole(d: Column) -> Column:
    """A double without a fraction that a long can hold."""
    return F.coalesce((F.abs(d) < 9.2e18) & (d == F.floor(d).cast("double")), F.lit(False))


def is_integral(c: Column) -> Column:
    """A number without a fraction that a long can hold, such as 7, 7.0 or 7e2."""
    return whole(to_double(c))


def to_long(c: Column) -> Column:
    """Exact for plain digits of any length that fits; numbers with a fraction give null."""
    s = strip(c)
    return F.when(is_integral(c), F.coalesce(s.try_cast("long"), s.try_cast("decimal(38,9)").try_cast("long"), to_double(c).try_cast("long")))


def to_decimal(c: Column, precision: int = 38, scale: int = 9) -> Column:
    return F.when(strip(c).rlike(NUMBER), strip(c).try_cast(f"decimal({precision},{scale})"))


def is_truth_word(c: Column) -> Column:
    return F.lower(c).isin(*TRUE_WORDS, *FALSE_WORDS)


def to_boolean(c: Column) -> Column:
    low = F.lower(strip(c))
    return F.when(low.isin(*TRUE_WORDS), True).when(low.isin(*FALSE_WORDS), False)


def log1p_count(n: Column) -> Column:
    return F.log1p(n.cast("double"))


def ratio(a: Column, b: Column) -> Column:
    """a / b; 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


#: Accepted forms of dates: name, the form a value must have, and the pattern that parses it (None: the ISO cast).
DATE_FORMS: tuple[tuple[str, str, str | None], ...] = (
    ("iso_date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", None),
    ("iso", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$", None),
    ("month_first", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    ("day_first", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "d/M/yyyy"),
    ("year_first", r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
    ("day_name", r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}$", "d-MMM-yyyy"),
    ("month_name", r"^[A-Za-z]{3} [0-9]{1,2}, [0-9]{4}$", "MMM d, yyyy"),
)


def parse_date_form(c: Column, form: str) -> Column:
    """A timestamp where the value has the named form and is a valid date; a column has one form."""
    return stripped_date_form(strip(c), form)


#: What all date forms begin with.
DATE_START = r"^([0-9]{1,4}[-/]|[A-Za-z]{3} )"


def stripped_date_form(s: Column, form: str) -> Column:
    _, regex, pattern = next(f for f in DATE_FORMS if f[0] == form)
    parsed = s.try_cast("timestamp") if pattern is None else F.try_to_timestamp(s, F.lit(pattern))
    return F.when(s.rlike(regex), parsed)


def time_part(c: Column) -> Column:
    """HH:mm:ss of a timestamp."""
    return F.date_format(c, "HH:mm:ss")
