"""Schemas by looking at the data: a type ladder over text columns, in one aggregation; and the check of suggested schemas."""

from __future__ import annotations

import json
import re
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import all_digits, strip
from ..functions.tokens import LOGICAL_TYPES
from ..functions.values import DATE_FORMS, DATE_START, is_truth_word, stripped_date_form, stripped_is_number, whole

Schema = list[dict[str, str]]
#: A column that numbers the rows of a frame and is no data. No cleaned name holds a space.
ROW_ORDER = "row idx"


def logical_type(kind: T.DataType) -> str:
    """The logical type of a Spark type."""
    if isinstance(kind, T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        return "INTEGER"
    if isinstance(kind, T.FloatType | T.DoubleType):
        return "FLOAT"
    if isinstance(kind, T.DecimalType):
        return "NUMERIC" if kind.scale <= 9 else "BIGNUMERIC"
    names = {T.BooleanType: "BOOLEAN", T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "DATETIME", T.DateType: "DATE", T.BinaryType: "BYTES", T.DayTimeIntervalType: "INTERVAL"}
    return names.get(type(kind), "STRING")


def column_statistics(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row a text column: how many values are there, and how many fit each type. A single aggregation over df.

    Cells become rows first, so that the code for one cell is small and compiled once, whatever
    the number of columns. Each cell is stripped once, and only what can be a number or a date is
    tried as one.
    """
    columns = df.columns if columns is None else columns
    cells = df.select(F.posexplode(F.array(*[F.col(f"`{c}`") for c in columns])).alias("position", "v")).withColumn("s", strip(F.col("v")))
    value, s = F.col("v"), F.col("s")
    cells = cells.withColumns({"d": F.when(stripped_is_number(s), s.try_cast("double")), "dated": F.coalesce(s.rlike(DATE_START), F.lit(False))})
    counts = [F.count("v").alias("n"), F.count("d").alias("n_number")]
    counts += [F.count_if(x).alias(n) for n, x in (("n_integral", whole(F.col("d"))), ("n_digits", all_digits(value)), ("n_truth", is_truth_word(value)))]
    counts += [F.count(F.when(F.col("dated"), stripped_date_form(s, form))).alias(f"n_{form}") for form, _, _ in DATE_FORMS]
    found = cells.groupBy("position").agg(*counts)
    # Every column has a row, also where df has none.
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "position int, name string")
    found = names.join(F.broadcast(found), "position", "left")  # a row a column
    return found.select("position", "name", *[F.coalesce(c, F.lit(0)).alias(c) for c in found.columns[2:]])


def sniffed(statistics: DataFrame) -> DataFrame:
    """position, name and type by the ladder INTEGER, FLOAT, TIMESTAMP, BOOLEAN, STRING."""
    n = F.col("n")
    dated = F.greatest(*[F.col(f"n_{form}") for form, _, _ in DATE_FORMS]) == n
    kind = (
        F.when(n == 0, "STRING").when(F.col("n_integral") == n, "INTEGER").when(F.col("n_number") == n, "FLOAT")
        .when((F.col("n_digits") < n) & dated, "TIMESTAMP").when(F.col("n_truth") == n, "BOOLEAN").otherwise("STRING")
    )
    return statistics.select("position", "name", kind.alias("type"))


def sniff_schema(df: DataFrame) -> Schema:
    """Of every column: text columns by their values, others by their type."""
    df = df.drop(ROW_ORDER)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    found = {r["name"]: r["type"] for r in sniffed(column_statistics(df, text)).collect()} if text else {}
    return [{"name": f.name, "type": found.get(f.name) or logical_type(f.dataType), "mode": "NULLABLE"} for f in df.schema.fields]


def sample_rows(df: DataFrame, order: str | list[str] | None, rows: int = 5) -> DataFrame:
    """The first rows in a stated order (without one, as they are read), as text, null as the word null."""
    first = (df.orderBy(order) if order else df).limit(rows)
    return first.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")).alias(c) for c in df.columns if c != ROW_ORDER])


def sample_text(df: DataFrame) -> str | None:
    """The rows of a sample as JSON; None where no cell holds anything."""
    rows = [r.asDict() for r in df.collect()]
    if all(v is None or v.strip() in ("", "null") for r in rows for v in r.values()):
        return None
    return json.dumps(rows, ensure_ascii=False)


def parse_suggestion(text: str) -> object:
    """JSON, also within a Markdown fence; None where it is neither."""
    for attempt in (text, re.sub(r"^\s*```(?:json)?\s*|\s*```\s*$", "", text)):
        try:
            return json.loads(attempt)
        except ValueError:
            continue
    return None


def check_suggestion(suggestion: object, columns: list[str]) -> Schema | None:
    """A suggested schema without names that the data lack; unknown types become STRING. None where it can't be used.

    It has to be a list of objects, each with a name and a type that are text and not empty; one
    that isn't spoils the whole.
    """
    if not isinstance(suggestion, list) or not suggestion:
        return None
    out = []
    for item in suggestion:
        if not isinstance(item, dict) or not all(isinstance(item.get(k), str) and item[k] for k in ("name", "type")):
            return None
        kind = item["type"].upper()
        if item["name"] in columns:
            out.append({"name": item["name"], "type": kind if kind in LOGICAL_TYPES else "STRING", "mode": "NULLABLE"})
    return out or None


def within(call: Callable[[], str], timeout_s: float | None) -> str:
    """The result of a call; a TimeoutError where it takes longer. It goes on in the background then."""
    if not timeout_s:
        return call()
    got: list = []

    def run() -> None:
        try:
            got.append((call(), None))
        except Exception as e:  # noqa: BLE001  raised below
            got.append((None, e))

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    thread.join(timeout_s)
    if not got:
        raise TimeoutError(f"no answer within {timeout_s} s")
    if got[0][1] is not None:
        raise got[0][1]
    return got[0][0]


def suggest_schema(df: DataFrame, suggester: Callable[[str, list[str]], str] | None, order: str | list[str] | None, rows: int = 5, timeout_s: float | None = None) -> Schema | None:
    """A schema from an injected function of (sample as JSON, column names) to JSON text; None without one, or where it fails or takes too long."""
    if suggester is None:
        return None
    columns = [c for c in df.columns if c != ROW_ORDER]
    sample = sample_text(sample_rows(df, order, rows))
    if sample is None:
        return None
    try:
        return check_suggestion(parse_suggestion(within(lambda: suggester(sample, columns), timeout_s)), columns)
    except Exception:  # noqa: BLE001  an outside service may fail in any way; another strategy then follows
        return None
