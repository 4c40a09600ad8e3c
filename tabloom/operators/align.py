"""Alignment: a frame takes exactly the columns, order and types of a schema; bad values become null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import values as V
from ..functions.tokens import STRING_NULLS
from .infer import Schema

SPARK_TYPES: dict[str, str] = {
    "INTEGER": "long", "INT64": "long", "FLOAT": "double", "FLOAT64": "double", "NUMERIC": "decimal(38,9)",
    "BIGNUMERIC": "decimal(38,18)", "BOOLEAN": "boolean", "BOOL": "boolean", "TIMESTAMP": "timestamp",
    "DATETIME": "timestamp_ntz", "DATE": "date", "TIME": "string", "STRING": "string", "JSON": "string",
    "BYTES": "string", "GEOGRAPHY": "string", "INTERVAL": "string",
}
DATED = ("TIMESTAMP", "DATETIME", "DATE", "TIME")


def spark_type(kind: str) -> str:
    if kind not in SPARK_TYPES:
        raise ValueError(f"columns of type {kind} can't be loaded")
    return SPARK_TYPES[kind]


def coerce(c: Column, kind: str, form: str | None = None) -> Column:
    """Text as a value of a logical type. form: of dates (functions.values.DATE_FORMS); without one, ISO."""
    if kind in ("INTEGER", "INT64"):
        return V.to_long(c)
    if kind in ("FLOAT", "FLOAT64"):
        return V.to_double(c)
    if kind in ("NUMERIC", "BIGNUMERIC"):
        return V.to_decimal(c, 38, 9 if kind == "NUMERIC" else 18)
    if kind in ("BOOLEAN", "BOOL"):
        return V.to_boolean(c)
    if kind in DATED:
        stamp = V.parse_date_form(c, form) if form else F.coalesce(V.parse_date_form(c, "iso_date"), V.parse_date_form(c, "iso"))
        return V.time_part(stamp) if kind == "TIME" else stamp.cast(spark_type(kind))
    if kind in ("STRING", "JSON", "BYTES"):
        return F.when(~c.isin(*STRING_NULLS), c)
    return c.cast(spark_type(kind))


def date_forms(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """The form that parses most values of each column, the earlier of equals; one aggregation."""
    if not columns:
        return {}
    counts = df.agg(*[F.count(V.parse_date_form(F.col(f"`{c}`"), form)).alias(f"_{k}_{j}") for k, c in enumerate(columns) for j, (form, _, _) in enumerate(V.DATE_FORMS)]).first()
    out: dict[str, str | None] = {}
    for k, c in enumerate(columns):
        own = [counts[f"_{k}_{j}"] for j in range(len(V.DATE_FORMS))]
        out[c] = V.DATE_FORMS[own.index(max(own))][0] if max(own) else None
    return out


def align(df: DataFrame, schema: Schema, strict_integers: bool = False) -> DataFrame:
    """df with the schema's columns in its order: others go, missing ones are null, text is coerced.

    A column that is typed already is cast. strict_integers: a column with a number that has a
    fraction is an error instead of giving nulls. REQUIRED columns without a value are an error.
    """
    kinds, text = dict(df.dtypes), {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    forms = date_forms(df, [f["name"] for f in schema if f["type"] in DATED and f["name"] in text])
    wrong = [f["name"] for f in schema if strict_integers and f["type"] in ("INTEGER", "INT64") and f["name"] in text]
    if wrong:
        bad = df.agg(*[F.count_if(V.is_number(F.col(f"`{c}`")) & ~V.is_integral(F.col(f"`{c}`"))).alias(f"_{k}") for k, c in enumerate(wrong)]).first()
        if named := [c for k, c in enumerate(wrong) if bad[k]]:
            raise ValueError(f"integer columns with fractions: {', '.join(named)}")
    out = []
    for f in schema:
        name, kind = f["name"], f["type"]
        if name not in kinds:
            value = F.lit(None).cast(spark_type(kind))
        elif name in text:
            value = coerce(F.col(f"`{name}`"), kind, forms.get(name))
        else:
            value = F.col(f"`{name}`").try_cast(spark_type(kind))
        out.append(value.alias(name, metadata={"logical_type": kind, "mode": f.get("mode", "NULLABLE")}))
    return df.select(*out)


def coercion_loss(df: DataFrame, schema: Schema) -> DataFrame:
    """One row a column of both: name, n_before, n_after (values that aren't null), n_lost, warn.

    warn: more than a tenth of the values were lost and more than five cells are null. One aggregation.
    """
    names = [f for f in schema if f["name"] in df.columns]
    forms = date_forms(df, [f["name"] for f in names if f["type"] in DATED])
    aggs = [F.count(F.lit(1)).alias("_all")]
    for k, f in enumerate(names):
        c = F.col(f"`{f['name']}`")
        aggs.append(F.struct(F.lit(f["name"]).alias("name"), F.count(c).alias("n_before"), F.count(coerce(c, f["type"], forms.get(f["name"]))).alias("n_after")).alias(f"_{k}"))
    one = df.agg(*aggs).select("_all", F.explode(F.array(*[F.col(f"_{k}") for k in range(len(names))])).alias("s")).select("_all", "s.*")
    lost = F.col("n_before") - F.col("n_after")
    return one.select("name", "n_before", "n_after", lost.alias("n_lost"), ((lost > 0.1 * F.col("n_before")) & (F.col("_all") - F.col("n_after") > 5)).alias("warn"))
