import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tabloom.functions.text import null_tokens, strip
from tabloom.operators import cells as C
from tabloom.operators.align import align, coercion_loss, spark_type
from tabloom.operators.clean import clean_table, drop_empty
from tabloom.operators.header import header_names, promotes
from tabloom.operators.infer import check_suggestion, parse_suggestion, sample_rows, sample_text, sniff_schema, suggest_schema
from tabloom.operators.schema import determine_schema, reconcile
from tabloom.plans.sink import load, struct_of


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_promotion():
    generic = ["0", "1", "2", "3"]
    assert promotes(["a", None, "b", "c"], generic) and header_names(["a", None, "b", "c"], 4) == ["a", "nan", "b", "c"]
    assert not promotes(["1", "1", "2"], generic[:3]) and header_names(None, 3) == ["_0", "_1", "_2"]
    assert not promotes(["a", "a", "a"], generic[:3]) and not promotes([], [])
    assert header_names(["2021", "2022", "2023"], 3) == ["_2021", "_2022", "_2023"]
    assert not promotes(["a", "b"], ["x", "y"]) and promotes(["a", "b", "c"], ["x", "x", "y"])


def test_clean_table(spark):
    rows = [["id", "Name", "name", None, "e"], ["1", " ann ", "NULL", None, None], [None] * 5, ["2", "\xa0bob", "n/a", None, None]]
    df = spark.createDataFrame([("f", "s", k, r) for k, r in enumerate(rows)], C.ROWS_SCHEMA)
    out = clean_table(df, 5)
    assert out.columns == ["id", "Name", "name_1"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [("1", "ann", None), ("2", "bob", "n/a")]


def test_clean_values(spark):
    want = {" x ": "x", "NULL": None, "NaT": None, "<NA>": None, "n/a": "n/a", "\xa0y　": "y", "": None, None: None}
    df = column(spark, want)
    assert {r[0]: r[1] for r in df.select("v", null_tokens(strip(F.col("v")))).collect()} == want


def test_drop_empty_of_nothing(spark):
    df = spark.createDataFrame([(None, None)], "a string, b string")
    assert drop_empty(df).columns == [] or drop_empty(df).count() == 0


@pytest.mark.parametrize(
    ("values", "kind"),
    [
        (["1", "2", "3"], "INTEGER"), (["1", None, "3"], "INTEGER"), (["0", "1", "0"], "INTEGER"), (["1.0", "2.0"], "INTEGER"), (["1", "2.5"], "FLOAT"), (["1e3", "0.5"], "FLOAT"),
        (["2024-01-02", "2024-02-03"], "TIMESTAMP"), (["01/02/2024", "13/02/2024"], "TIMESTAMP"), (["yes", "no", "y"], "BOOLEAN"), (["true", "0", "1"], "BOOLEAN"), (["a", "1"], "STRING"),
        ([None, None], "STRING"), (["1d", "2"], "STRING"), (["2024-01-02", "01/02/2024"], "STRING"), (["2024-13-02"], "STRING"),
    ],
)
def test_sniffing(spark, values, kind):
    assert sniff_schema(column(spark, values))[0]["type"] == kind


def test_sniffing_of_typed_columns(spark):
    df = spark.sql("SELECT 1 AS a, 1.5D AS b, true AS c, timestamp'2024-01-01 00:00:00' AS d, date'2024-01-01' AS e, cast(1 AS decimal(10,2)) AS f, 'x' AS g")
    assert [f["type"] for f in sniff_schema(df)] == ["INTEGER", "FLOAT", "BOOLEAN", "TIMESTAMP", "DATE", "NUMERIC", "STRING"]


def one(spark, values, kind, **options):
    return [r[0] for r in align(column(spark, values).coalesce(1), [{"name": "v", "type": kind}], **options).collect()]


def test_alignment(spark):
    assert one(spark, ["7", "x", "", "2.5", "9007199254740993", "1e2"], "INTEGER") == [7, None, None, None, 9007199254740993, 100]
    assert one(spark, ["T", "0.0", "maybe"], "BOOLEAN") == [True, False, None]
    assert one(spark, ["1.5", "1d", "1_0"], "FLOAT") == [1.5, None, None]
    assert one(spark, ["1.25", "x"], "NUMERIC") == [Decimal("1.25"), None]
    assert one(spark, ["01/02/2024", "x", "3/4/2024"], "DATE") == [dt.date(2024, 1, 2), None, dt.date(2024, 3, 4)]
    assert one(spark, ["13/02/2024", "01/02/2024"], "DATE") == [dt.date(2024, 2, 13), dt.date(2024, 2, 1)]
    assert one(spark, ["2024-01-02 03:04:05", "10:11:12", "2024"], "TIME") == ["03:04:05", None, None]
    assert one(spark, ["nan", "<NA>", "NaN", None], "STRING") == [None, None, "NaN", None]
    with pytest.raises(ValueError, match="fractions"):
        one(spark, ["1", "2.5"], "INTEGER", strict_integers=True)
    with pytest.raises(ValueError, match="RECORD"):
        spark_type("RECORD")


def test_shape(spark):
    df = spark.createDataFrame([("yes", "7", "z")], "b string, a string, extra string")
    schema = [{"name": "a", "type": "INTEGER"}, {"name": "c", "type": "STRING"}, {"name": "b", "type": "BOOLEAN"}]
    out = align(df, schema)
    assert out.columns == ["a", "c", "b"] and tuple(out.first()) == (7, None, True)
    with pytest.raises(ValueError, match="in common"):
        reconcile(["x"], ["y"])


@pytest.mark.parametrize(("bad", "warn"), [(6, True), (5, False)])
def test_loss(spark, bad, warn):
    df = column(spark, [str(k) for k in range(20 - bad)] + ["x"] * bad)
    r = coercion_loss(df, [{"name": "v", "type": "INTEGER"}]).first()
    assert (r["n_before"], r["n_after"], r["n_lost"], r["warn"]) == (20, 20 - bad, bad, warn)


def test_suggestions(spark):
    df = spark.createDataFrame([("1", None)], "a string, b string")
    seen = []
    good = lambda sample, columns: seen.append((sample, columns)) or '```json\n[{"name": "a", "type": "integer"}]\n```'
    assert suggest_schema(df, good, "a") == [{"name": "a", "type": "INTEGER", "mode": "NULLABLE"}]
    assert seen == [('[{"a": "1", "b": "null"}]', ["a", "b"])]
    assert suggest_schema(df, lambda s, c: 1 / 0, "a") is None and suggest_schema(df, None, "a") is None
    assert sample_text(sample_rows(spark.createDataFrame([(None, " ")], "a string, b string"), "a")) is None
    assert parse_suggestion("no") is None and check_suggestion([{"name": "a"}], ["a"]) is None and check_suggestion([], ["a"]) is None


def test_strategies_and_dispositions(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_load")
    df = spark.createDataFrame([("1", "x"), ("2", "y")], "a string, b string")
    schema = determine_schema(df, "t_load.one", "existing_or_suggest_or_sniff")
    assert [f["type"] for f in schema] == ["INTEGER", "STRING"]
    assert determine_schema(df, "t_load.one", "existing_or_suggest") is None
    aligned = align(df, schema)
    assert load(aligned, "t_load.one", schema, "WRITE_EMPTY", count=True) == 2
    assert load(aligned, "t_load.one", schema, "WRITE_APPEND", 60, count=True) == 4
    with pytest.raises(ValueError, match="isn't empty"):
        load(aligned, "t_load.one", schema, "WRITE_EMPTY")
    assert load(aligned, "t_load.one", schema, "WRITE_TRUNCATE", count=True) == 2
    assert load(aligned.limit(0), "t_load.one", schema) is None and spark.table("t_load.one").count() == 2
    assert [f["type"] for f in determine_schema(df.select("a"), "t_load.one", "existing")] == ["INTEGER", "STRING"]
    with pytest.raises(ValueError, match="unknown step"):
        determine_schema(df, "t_load.one", "guess")
    with pytest.raises(ValueError, match="empty schema"):
        load(aligned, "t_load.two", [])
    with pytest.raises(ValueError, match="nulls"):
        load(align(spark.createDataFrame([("x",)], "a string"), [{"name": "a", "type": "INTEGER"}]), "t_load.three", [{"name": "a", "type": "INTEGER", "mode": "REQUIRED"}])
    with pytest.raises(ValueError, match="name and a type"):
        struct_of([{"name": "a"}])
