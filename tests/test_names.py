import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabloom.functions.text import clean_name, file_extension, generic_names, sanitize_name, strip, table_name, unique_names
from tabloom.plans.pipeline import target_name


def test_clean_name():
    cases = {" Unit Price ($) ": "Unit_Price____", "2nd": "_2nd", "": "_unnamed", "   ": "_unnamed", "é1": "_é1", "a" * 400: "a" * 300}
    assert {k: clean_name(k) for k in cases} == cases


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_clean_name_is_valid_and_stable(name):
    new = clean_name(name)
    assert re.match(r"[A-Za-z_]\w*$", new) and clean_name(new) == new and len(new) <= 300


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "A", "a_1", "b", "a_2", "A_1", "x" * 300])))
def test_unique_names(names):
    out = unique_names(names)
    assert len({n.lower() for n in out}) == len(names) and all(len(n) <= 300 for n in out)


def test_repeats_are_numbered():
    assert unique_names(["a", "b", "a", "c", "d", "e"]) == ["a", "b", "a_1", "c", "d", "e"]
    assert unique_names(["a", "a", "a_1"]) == ["a", "a_1", "a_1_1"]
    assert generic_names(["0", "Unnamed: 3"]) and not generic_names(["0", "name"])


def test_columns_agree_with_the_driver(spark):
    names = [" Unit Price ($) ", "2nd", "", "   ", "é1", "a" * 400, "　x y ", None, "nan"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(sanitize_name(F.col("n"))).collect()]
    assert got == [clean_name("None" if n is None else n) for n in names]
    assert [r[0] for r in df.select(strip(F.col("n"))).collect()] == [None if n is None else n.strip() for n in names]


def test_extensions(spark):
    want = {"a.CSV": ".csv", "d.x/a": "", ".bashrc": "", "..a.b": ".b", "a.": ".", "a.tar.gz": ".gz", "x/.y.xlsx": ".xlsx", "": ""}
    df = spark.createDataFrame([(k,) for k in want], "p string")
    assert {r[0]: r[1] for r in df.select("p", file_extension(F.col("p"))).collect()} == want


def test_table_names(spark):
    cases = [("in/f.csv", "_default_", 1, 1, 1), ("f.csv", "_default_", 1, 1, 2), ("f.xlsx", "Sheet1", 1, 1, 1), ("f.xlsx", "Sheet1", 1, 1, 2), ("my f.xlsx", "A b", 2, 3, 2)]
    want = ["f", "f__default__table_1", "f_Sheet1", "f_Sheet1_table_1", "my_f_A_b_table_2"]
    assert [target_name(*c) for c in cases] == want
    df = spark.createDataFrame(cases, "p string, s string, t int, ns int, nt int")
    assert [r[0] for r in df.select(table_name(*map(F.col, ("p", "s", "t", "ns", "nt")))).collect()] == want
