"""Every query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SQL = entry.oracle_sql()


def test_entry(spark):
    got = [tuple(r) for r in entry.entry(spark).orderBy("table_id").collect()]
    assert got == [
        ("table_1", 0, 0, 25, 2, 0.663694, 25, "n_nationkey,n_name,n_regionkey", "INTEGER,STRING,INTEGER"),
        ("table_2", 40, 6, 45, 7, 0.645649, 5, "r_regionkey,r_name", "INTEGER,STRING"),
    ]


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for f in os.listdir(sf_dir):
        db.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    want = db.sql(SQL[name])
    got = entry.queries()[name](spark, sf_dir)
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    at = [want.columns.index(n) for n in names]
    assert sorted(repr(tuple(r[n] for n in names)) for r in got.collect()) == sorted(repr(tuple(r[k] for k in at)) for r in want.fetchall())


@pytest.mark.parametrize("name", ["align_float", "align_decimal", "coercion_loss"])
def test_numbers_against_sql_for_prices_with_more_decimals(spark, tmp_path, name):
    """Prices halfway between two cents, which their exact binary value decides, are rounded as by SQL; null ones stay null."""
    prices = [k * 7919 % 10_000_019 / 1000 for k in range(4000)] + [0.125, 0.375, 2.675, 1.005, -2.675, -0.001, 0.0, 0.995, 387374.855, 8999999999999.995, None]
    path = str(tmp_path / "orders.parquet")
    db = duckdb.connect()
    db.execute("CREATE TABLE orders AS SELECT (5 * k + 1)::BIGINT AS o_orderkey, k::BIGINT AS o_custkey, p AS o_totalprice FROM (SELECT unnest(?::DOUBLE[]) AS p, unnest(range(?)) AS k)", [prices, len(prices)])
    db.execute(f"COPY orders TO '{path}'")
    want = db.sql(SQL[name])
    got = entry.queries()[name](spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))
