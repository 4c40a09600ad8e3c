"""Queries over the driver's tables, one or more for each operator, and the SQL that says the same.

Grids are built from the tables by casting to text. Nothing is filtered away to make a query cheap,
except in the grid of hours and users, which keeps one event a cell; components_bbox_all_events has all of them.
"""

from __future__ import annotations

import csv
import io
import posixpath
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import text as X
from ..functions.values import DATE_FORMS
from ..operators import cells as C
from ..operators import clean as CL
from ..operators import detect as D
from ..operators import header as H
from ..operators import infer as I
from ..operators.align import align, coercion_loss
from ..operators import schema as SC
from ..operators.schema import reconciled
from ..sources.messages import parse_messages, route
from ..storage import put, shared_dir
from .ledger import Ledger
from .pipeline import process_object, settle
from .sink import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- pieces of SQL -----------------------------------------------------------------------------

SP = r"[\s\x0B\x1c-\x1f\x{85}\pZ]"
NUM = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INF = r"^[+-]?(?i:inf|infinity)$"
MASK = "('None','none','null','NULL','NaN','NAN','<NA>','na','N/A','n/a')"
TRUE, FALSE = "('true','t','yes','y','1','1.0')", "('false','f','no','n','0','0.0')"


def s_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{SP}+|{SP}+$', '', 'g')"


def s_null(c: str) -> str:
    return f"CASE WHEN lower({c}) IN ('','none','null','nan','<na>','nat') THEN NULL ELSE {c} END"


def s_content(c: str) -> str:
    return f"({c} IS NOT NULL AND NOT regexp_matches({c}, '^{SP}*$') AND {c} NOT IN {MASK})"


def s_name(c: str) -> str:
    s = f"regexp_replace({s_strip(f'coalesce({c}, {chr(39)}None{chr(39)})')}, '[^\\pL\\pN_]', '_', 'g')"
    return f"left(CASE WHEN {s} = '' THEN '_unnamed' WHEN regexp_matches({s}, '^[A-Za-z_]') THEN {s} ELSE '_' || {s} END, 300)"


def s_isnum(c: str) -> str:
    return f"(regexp_matches({s_strip(c)}, '{NUM}') OR regexp_matches({s_strip(c)}, '{INF}'))"


def s_double(c: str) -> str:
    return f"CASE WHEN {s_isnum(c)} THEN try_cast({s_strip(c)} AS DOUBLE) END"


def s_isint(c: str) -> str:
    return f"coalesce(abs({s_double(c)}) < 9.2e18 AND {s_double(c)} = floor({s_double(c)}), false)"


def s_form(c: str, form: str) -> str:
    s = s_strip(c)
    regex = next(r for f, r, _ in DATE_FORMS if f == form)
    pattern = {"month_first": "%m/%d/%Y", "day_first": "%d/%m/%Y", "year_first": "%Y/%m/%d", "day_name": "%d-%b-%Y", "month_name": "%b %d, %Y"}.get(form)
    parsed = f"try_strptime({s}, '{pattern}')" if pattern else f"try_cast({s} AS TIMESTAMP)"
    return f"CASE WHEN regexp_matches({s}, '{regex}') THEN {parsed} END"


def typed(c: str, kind: str) -> str:
    """A column as the text that Spark gives for it."""
    if kind == "double":
        return f"CASE WHEN {c} IS NULL THEN NULL ELSE printf('%.2f', {c}) END"
    if kind == "timestamp":
        return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
    return f"CAST({c} AS VARCHAR)"


TABLES: dict[str, list[tuple[str, str]]] = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "int"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "int"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "int"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "int"), ("o_custkey", "int"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp"), ("o_orderpriority", "string")],
    "lineitem": [
        ("l_orderkey", "int"), ("l_partkey", "int"), ("l_suppkey", "int"), ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
        ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp"),
    ],
    "events": [("event_id", "int"), ("ts", "timestamp"), ("user_id", "int"), ("event_type", "string"), ("value", "double"), ("props", "string")],
    "labels": [("doc_id", "int"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "int"), ("turn", "int"), ("role", "string"), ("text", "string")],
}


def two_decimals(c):
    """A double as printf('%.2f') of C and of SQL gives it: its exact value rounded, ties to even; null stays null.

    Spark's format_string rounds the shortest decimal form instead, so that 2.675, which is less than it looks, becomes
    2.68. Beyond 9e13, where neighbours are more than a hundredth apart, and for 0 and NaN its form is taken.
    """
    a = F.abs(c)
    p = a * 100
    # a * 100 is p + err exactly: a in two parts, whose products with 100 have no rounding.
    high = a * 134217729.0 - (a * 134217729.0 - a)
    err = (high * 100 - p) + (a - high) * 100
    low = F.floor(p)
    over = p - low.cast("double") - 0.5
    n = low + F.when((over > -err) | ((over == -err) & (low % 2 == 1)), 1).otherwise(0)
    exact = F.concat(F.when(c < 0, "-").otherwise(""), F.floor(n / 100).cast("string"), F.lit("."), F.lpad((n % 100).cast("string"), 2, "0"))
    return F.when((a > 0) & (a < 9e13), exact).when(c.isNotNull(), F.format_string("%.2f", c))


def as_text(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with all columns as text; amounts with two decimals, times without a fraction."""
    kinds = {"double": two_decimals, "timestamp": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")}
    df = table(spark, sf_dir, name)
    return df.select(*[F.when(F.col(c).isNotNull(), kinds.get(k, lambda x: x.cast("string"))(F.col(c))).alias(c) for c, k in TABLES[name]])


# ---- names ---------------------------------------------------------------------------------------


@query(
    "sanitize_name",
    f"SELECT 'part' AS kind, p_partkey AS id, {s_name('p_name')} AS name FROM part UNION ALL SELECT 'document', doc_id, {s_name('text')} FROM documents"
    f" UNION ALL SELECT 'page', page_id, {s_name('url')} FROM pages",
)
def sanitize_name(spark, d):
    one = lambda t, kind, key, c: table(spark, d, t).select(F.lit(kind).alias("kind"), F.col(key).alias("id"), X.sanitize_name(F.col(c)).alias("name"))
    return one("part", "part", "p_partkey", "p_name").union(one("documents", "document", "doc_id", "text")).union(one("pages", "page", "page_id", "url"))


@query(
    "dedup_names",
    "SELECT p_partkey, CASE WHEN k = 0 THEN p_brand ELSE left(p_brand || '_' || k, 300) END AS name"
    " FROM (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS k FROM part)",
)
def dedup_names(spark, d):
    return CL.numbered_repeats(table(spark, d, "part"), "p_brand", "p_partkey", "name").select("p_partkey", "name")


_EXT = r"lower(regexp_extract(regexp_extract({0}, '(?s)([^/]*)$', 1), '(?s)^\.*[^.].*?(\.[^.]*)$', 1))"


@query("file_extension", f"SELECT page_id, {_EXT.format('url')} AS url_ext, {_EXT.format(chr(39) + '.' + chr(39) + ' || url')} AS hidden_ext FROM pages")
def file_extension(spark, d):
    return table(spark, d, "pages").select("page_id", X.file_extension(F.col("url")).alias("url_ext"), X.file_extension(F.concat(F.lit("."), "url")).alias("hidden_ext"))


@query(
    "table_name",
    "WITH n AS (SELECT n_nationkey AS k, 'in/' || n_name || '.v1.xlsx' AS path, CASE WHEN n_regionkey = 0 THEN '_default_' ELSE r_name END AS sheet,"
    " 1 + n_nationkey % 3 AS tab, 1 + n_regionkey % 2 AS n_sheets, 1 + n_nationkey % 2 AS n_tables FROM nation JOIN region ON n_regionkey = r_regionkey)"
    f" SELECT k, left(concat_ws('_', {s_name('regexp_extract(path, ' + chr(39) + '([^/]*)[.]xlsx$' + chr(39) + ', 1)')},"
    f" CASE WHEN sheet <> '_default_' OR n_sheets > 1 OR n_tables > 1 THEN {s_name('sheet')} END, CASE WHEN n_tables > 1 THEN 'table_' || tab END), 1024) AS target FROM n",
)
def table_name(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sheet = F.when(F.col("n_regionkey") == 0, C.DEFAULT_SHEET).otherwise(F.col("r_name"))
    path = F.concat(F.lit("in/"), "n_name", F.lit(".v1.xlsx"))
    return n.select(F.col("n_nationkey").alias("k"), X.table_name(path, sheet, 1 + F.col("n_nationkey") % 3, 1 + F.col("n_regionkey") % 2, 1 + F.col("n_nationkey") % 2).alias("target"))


# ---- cleaning --------------------------------------------------------------------------------------

_PADS = ("", " ", " ", "　", "\t")
_PAD_SQL = "['', ' ', chr(160), chr(12288), chr(9)][(doc_id % 5 + 1)::INT]"


@query("strip_ws", f"SELECT doc_id, {s_strip(f'({_PAD_SQL} || text || {_PAD_SQL})')} AS stripped FROM documents")
def strip_ws(spark, d):
    pad = F.element_at(F.array(*map(F.lit, _PADS)), (F.col("doc_id") % 5 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", X.strip(F.concat(pad, "text", pad)).alias("stripped"))


_TOKENS = ("", "None", "NULL", "NaN", "<NA>", "NaT", "n/a", "na", " null ", "  ", "kept")
_TOKEN_SQL = "[" + ", ".join(f"'{t}'" for t in _TOKENS) + "]"


def token_customers(spark, d) -> DataFrame:
    """Customers as text, with a word for a missing value in place of some names and balances."""
    df = as_text(spark, d, "customer").withColumn("k", F.col("c_custkey").cast("long"))
    name = F.when(F.col("k") % 13 < len(_TOKENS), F.element_at(F.array(*map(F.lit, _TOKENS)), (F.least(F.col("k") % 13, F.lit(len(_TOKENS) - 1)) + 1).cast("int"))).otherwise(F.col("c_name"))
    return df.withColumn("c_name", name).withColumn("c_acctbal", F.when(F.col("k") % 4 != 0, F.col("c_acctbal")))


TOKEN_CUSTOMERS = (
    f"(SELECT c_custkey AS k, {typed('c_custkey', 'int')} AS c_custkey, CASE WHEN c_custkey % 13 < {len(_TOKENS)} THEN {_TOKEN_SQL}[(least(c_custkey % 13, {len(_TOKENS) - 1}) + 1)::INT] ELSE c_name END AS c_name,"
    f" {typed('c_nationkey', 'int')} AS c_nationkey, CASE WHEN c_custkey % 4 <> 0 THEN {typed('c_acctbal', 'double')} END AS c_acctbal, c_mktsegment FROM customer)"
)


@query("null_tokens", f"SELECT k, {s_null(s_strip('c_name'))} AS c_name, {s_null(s_strip('c_acctbal'))} AS c_acctbal FROM {TOKEN_CUSTOMERS}")
def null_tokens(spark, d):
    return CL.clean_values(token_customers(spark, d).select("k", "c_name", "c_acctbal"), ["c_name", "c_acctbal"])


@query(
    "drop_empty_cols_rows",
    f"SELECT k, a, b FROM (SELECT k, CASE WHEN k % 3 <> 0 THEN c_name END AS a, CASE WHEN k % 2 <> 0 THEN c_acctbal END AS b FROM {TOKEN_CUSTOMERS}) WHERE a IS NOT NULL OR b IS NOT NULL",
)
def drop_empty_cols_rows(spark, d):
    df = token_customers(spark, d).select("k", F.when(F.col("k") % 3 != 0, F.col("c_name")).alias("a"), F.lit(None).cast("string").alias("gone"), F.when(F.col("k") % 2 != 0, F.col("c_acctbal")).alias("b"))
    return CL.drop_empty(df, ["a", "gone", "b"])


# ---- grids -----------------------------------------------------------------------------------------


def customer_rows(spark, d) -> DataFrame:
    """A grid with a sheet for each market segment."""
    df = token_customers(spark, d)
    return C.rows_from_table(df, ["c_custkey", "c_name", "c_nationkey", "c_acctbal"], F.col("k"), "customer", F.col("c_mktsegment"))


CUSTOMER_CELLS = f"(SELECT c_mktsegment AS sheet, k::INT AS row_idx, unnest([0, 1, 2, 3]) AS col_idx, unnest([c_custkey, c_name, c_nationkey, c_acctbal]) AS value FROM {TOKEN_CUSTOMERS})"


@query(
    "content_mask_density",
    f"SELECT 'customer' AS object, sheet, count(*) AS n_cells, count(*) FILTER (WHERE {s_content('value')}) AS n_content,"
    f" (count(*) FILTER (WHERE {s_content('value')}))::DOUBLE / count(*) AS density FROM {CUSTOMER_CELLS} GROUP BY sheet",
)
def content_mask_density(spark, d):
    return C.sheet_density(C.to_cells(customer_rows(spark, d)))


@query(
    "grid_to_cells",
    "SELECT 'orders' AS object, '_default_' AS sheet, o_orderkey::INT AS row_idx, unnest([0, 1, 2, 3])::INT AS col_idx,"
    " unnest([o_custkey::VARCHAR, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority]) AS value FROM orders",
)
def grid_to_cells(spark, d):
    return C.to_cells(C.rows_from_table(as_text(spark, d, "orders"), ["o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"], F.col("o_orderkey"), "orders"))


@query(
    "cut_rectangle",
    f"SELECT 'customer' AS object, sheet, row_idx - 10 AS row_idx, col_idx - 1 AS col_idx, value FROM {CUSTOMER_CELLS} WHERE row_idx BETWEEN 10 AND 900 AND col_idx BETWEEN 1 AND 2",
)
def cut_rectangle(spark, d):
    return C.cut_rectangle(C.to_cells(customer_rows(spark, d)), 10, 1, 900, 2)


@query(
    "row_density_trim",
    f"WITH r AS (SELECT *, (c_custkey IS NOT NULL)::INT + (c_name IS NOT NULL AND c_name NOT IN ('None','nan','NaN','<NA>',''))::INT + (c_acctbal IS NOT NULL)::INT AS n"
    f" FROM (SELECT k, c_mktsegment, CASE WHEN k BETWEEN 200 AND 1200 THEN c_custkey END AS c_custkey, CASE WHEN k % 5 = 0 THEN c_name END AS c_name, CASE WHEN k BETWEEN 200 AND 1200 THEN c_acctbal END AS c_acctbal FROM {TOKEN_CUSTOMERS})),"
    " e AS (SELECT c_mktsegment, min(k) FILTER (WHERE n >= 2) AS a, max(k) FILTER (WHERE n >= 2) AS b FROM r GROUP BY ALL)"
    " SELECT c_mktsegment AS sheet, k::INT AS row_idx, n AS n_values FROM r JOIN e USING (c_mktsegment) WHERE k BETWEEN a AND b",
)
def row_density_trim(spark, d):
    df = token_customers(spark, d)
    mid = F.col("k").between(200, 1200)
    df = df.select("k", "c_mktsegment", F.when(mid, F.col("c_custkey")).alias("a"), F.when(F.col("k") % 5 == 0, F.col("c_name")).alias("b"), F.when(mid, F.col("c_acctbal")).alias("c"))
    rows = C.trim_sparse_rows(C.rows_from_table(df, ["a", "b", "c"], F.col("k"), "customer", F.col("c_mktsegment")), 0.7)
    n = F.size(F.filter("cells", lambda v: v.isNotNull() & ~v.isin("None", "nan", "NaN", "<NA>", "")))
    return rows.select("sheet", "row_idx", n.alias("n_values"))


# ---- detection -------------------------------------------------------------------------------------


def event_cells(spark, d) -> DataFrame:
    """A sheet for each type of event: a row for each hour of the week, a column for each of 48 classes of users.

    A cell keeps its smallest event_id, so a sheet has at most 168 x 48 cells however many events there are.
    """
    e = table(spark, d, "events")
    row = (F.hour("ts") + 24 * F.dayofweek("ts") - 24).cast("int")
    at = e.groupBy(F.col("event_type").alias("sheet"), row.alias("row_idx"), (F.col("user_id") % 48).cast("int").alias("col_idx")).agg(F.min("event_id").alias("id"))
    value = F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise(F.concat(F.lit("e"), F.col("id").cast("string")))
    return at.select(F.lit("events").alias("object"), "sheet", "row_idx", "col_idx", value.alias("value"))


EVENT_CTE = """
cells AS MATERIALIZED (
  SELECT sheet, r, c, CASE WHEN id % 3 = 0 THEN id::VARCHAR ELSE 'e' || id END AS value
  FROM (SELECT event_type AS sheet, (hour(ts) + 24 * dayofweek(ts))::INT AS r, (user_id % 48)::INT AS c, min(event_id) AS id FROM events GROUP BY ALL)),
reach AS (
  SELECT sheet, r, c, r * 1000 + c AS lab FROM cells
  UNION
  SELECT n.sheet, n.r, n.c, x.lab FROM reach x JOIN cells n ON n.sheet = x.sheet AND n.r BETWEEN x.r - 1 AND x.r + 1 AND n.c BETWEEN x.c - 1 AND x.c + 1 AND x.lab < n.r * 1000 + n.c),
labels AS (SELECT sheet, r, c, min(lab) AS lab FROM reach GROUP BY ALL),
boxes AS (SELECT sheet, min(r)::INT AS r1, min(c)::INT AS c1, max(r)::INT AS r2, max(c)::INT AS c2, count(*) AS n_own FROM labels GROUP BY sheet, lab)
"""
BOX_STATS = """
, large AS (SELECT * FROM boxes WHERE r2 - r1 + 1 >= 3 AND c2 - c1 + 1 >= 2),
stats AS (
  SELECT b.sheet, r1, c1, r2, c2, n_own, (r2 - r1 + 1) * (c2 - c1 + 1)::BIGINT AS n_cells, count(*) AS n_content,
         c2 - c1 + 1 AS nn, count(DISTINCT value) FILTER (WHERE r = r1) + (count(*) FILTER (WHERE r = r1) < c2 - c1 + 1)::INT AS d,
         count(*) FILTER (WHERE r = r1 AND value NOT LIKE 'e%') AS num
  FROM large b JOIN cells k ON k.sheet = b.sheet AND r BETWEEN r1 AND r2 AND c BETWEEN c1 AND c2 GROUP BY b.sheet, r1, c1, r2, c2, n_own),
scored AS (
  SELECT *, n_content::DOUBLE / n_cells AS density,
         CASE WHEN d::DOUBLE / nn >= 0.48 THEN CASE WHEN num::DOUBLE / nn < 0.4 THEN 0.4 WHEN d = nn THEN 0.3 ELSE 0.1 END ELSE 0.0 END AS header FROM stats),
final AS (
  SELECT *, CASE WHEN r2 - r1 + 1 - (header >= 0.3)::INT < 2 THEN -1.0 ELSE 0.5 * density + 0.3 * header + 0.01 * ln(1 + n_content) END AS score FROM scored WHERE density >= 0.25)
"""


ALL_EVENTS_CTE = EVENT_CTE.replace(
    "(hour(ts) + 24 * dayofweek(ts))::INT AS r, (user_id % 48)::INT AS c, min(event_id) AS id FROM events GROUP BY ALL", "(event_id // 100)::INT AS r, (event_id % 100)::INT AS c, event_id AS id FROM events"
)


@query("components_bbox_all_events", f"WITH RECURSIVE {ALL_EVENTS_CTE} SELECT 'events' AS object, * FROM boxes")
def components_bbox_all_events(spark, d):
    """A grid that grows with the table: every event has a cell of its own, 100 in a row."""
    at = table(spark, d, "events").select(F.col("event_type").alias("sheet"), F.floor(F.col("event_id") / 100).cast("int").alias("row_idx"), (F.col("event_id") % 100).cast("int").alias("col_idx"), F.col("event_id").cast("string").alias("value"))
    return D.label_by_size(at.withColumn("object", F.lit("events")))


@query("components_bbox_by_size", f"WITH RECURSIVE {EVENT_CTE} SELECT 'events' AS object, * FROM boxes")
def components_bbox_by_size(spark, d):
    return D.label_by_size(event_cells(spark, d))


@query("components_bbox", f"WITH RECURSIVE {EVENT_CTE} SELECT 'events' AS object, * FROM boxes")
def components_bbox(spark, d):
    return D.label_distributed(event_cells(spark, d))


@query("components_bbox_grouped", f"WITH RECURSIVE {EVENT_CTE} SELECT 'events' AS object, * FROM boxes")
def components_bbox_grouped(spark, d):
    return D.label_grouped(event_cells(spark, d))


@query("region_filter", f"WITH RECURSIVE {EVENT_CTE} {BOX_STATS} SELECT sheet, r1, c1, r2, c2, n_cells::BIGINT AS n_cells, n_content, round(density, 6) AS density FROM scored WHERE density >= 0.25")
def region_filter(spark, d):
    cells = event_cells(spark, d)
    out = D.box_counts(D.large_enough(D.label_grouped(cells)), cells).withColumn("density", F.col("n_content") / F.col("n_cells"))
    return out.where("density >= 0.25").select("sheet", *D.BOX_COLUMNS, "n_cells", "n_content", F.round("density", 6).alias("density"))


@query("region_score", f"WITH RECURSIVE {EVENT_CTE} {BOX_STATS} SELECT sheet, r1, c1, r2, c2, nn::INT AS nn, d::INT AS d, num, round(score, 6) AS score FROM final WHERE score > -0.5")
def region_score(spark, d):
    cells = event_cells(spark, d)
    out = D.scored(D.large_enough(D.label_grouped(cells)), cells)
    return out.select("sheet", *D.BOX_COLUMNS, F.col("nn").cast("int"), F.col("d").cast("int"), "num", F.round("score", 6).alias("score"))


@query(
    "detect_tables",
    f"""WITH RECURSIVE {EVENT_CTE} {BOX_STATS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY score DESC, r1, c1) AS k FROM final WHERE score > -0.5),
walk AS (
  SELECT sheet, 0::BIGINT AS k, []::STRUCT(r1 INT, c1 INT, r2 INT, c2 INT, k BIGINT)[] AS kept FROM (SELECT DISTINCT sheet FROM ranked)
  UNION ALL
  SELECT w.sheet, w.k + 1, CASE WHEN len(list_filter(w.kept, lambda b: b.r1 <= n.r2 AND n.r1 <= b.r2 AND b.c1 <= n.c2 AND n.c1 <= b.c2)) = 0
         THEN list_append(w.kept, struct_pack(r1 := n.r1, c1 := n.c1, r2 := n.r2, c2 := n.c2, k := n.k)) ELSE w.kept END
  FROM walk w JOIN ranked n ON n.sheet = w.sheet AND n.k = w.k + 1),
chosen AS (SELECT sheet, unnest(kept) AS b, generate_subscripts(kept, 1) AS place FROM (SELECT sheet, arg_max(kept, k) AS kept FROM walk GROUP BY sheet))
SELECT 'events' AS object, r.sheet, 'table_' || place AS table_id, r1, c1, r2, c2, n_cells::BIGINT AS n_cells, n_content AS n_nonnull, round(score, 6) AS score
FROM chosen c JOIN ranked r ON r.sheet = c.sheet AND r.k = c.b.k""",
)
def detect_tables(spark, d):
    return D.detect_tables(event_cells(spark, d)).withColumn("score", F.round("score", 6))


@query("detect_tables_distributed", ORACLE_SQL["detect_tables"])
def detect_tables_distributed(spark, d):
    return D.detect_tables(event_cells(spark, d), "distributed").withColumn("score", F.round("score", 6))


@query(
    "whole_sheet_detect",
    f"""WITH s AS (SELECT sheet, max(row_idx)::INT AS r2, max(col_idx)::INT AS c2, count(*) FILTER (WHERE {s_content("value")}) AS n FROM {CUSTOMER_CELLS} GROUP BY sheet),
f AS (SELECT s.sheet, count(*) FILTER (WHERE row_idx = 0) AS have, count(*) FILTER (WHERE row_idx = 0 AND coalesce(value, 'nan') NOT IN {MASK} AND value IS DISTINCT FROM '') AS known,
        count(DISTINCT coalesce(value, 'nan')) FILTER (WHERE row_idx = 0) AS words, count(*) FILTER (WHERE row_idx = 0 AND coalesce({s_isnum("value")}, false)) AS num,
        coalesce(bool_or(value IS NULL) FILTER (WHERE row_idx = 0), false) AS holes FROM s JOIN {CUSTOMER_CELLS} c ON c.sheet = s.sheet GROUP BY s.sheet),
g AS (SELECT s.*, known + 4 - have AS nn, words + (have < 4 AND NOT holes)::INT AS d, num, n::DOUBLE / ((r2 + 1) * 4) AS density FROM s JOIN f USING (sheet)),
h AS (SELECT *, CASE WHEN nn > 0 AND d::DOUBLE / nn >= 0.48 THEN CASE WHEN num::DOUBLE / nn < 0.4 THEN 0.4 WHEN d = 4 THEN 0.3 ELSE 0.1 END ELSE 0.0 END AS header FROM g)
SELECT sheet, 'table_1' AS table_id, 0 AS r1, 0 AS c1, r2, c2, ((r2 + 1) * 4)::BIGINT AS n_cells, n AS n_nonnull, round(0.5 * density + 0.3 * header + 0.01 * ln(1 + n), 6) AS score FROM h WHERE density >= 0.125""",
)
def whole_sheet_detect(spark, d):
    return D.detect_tables(C.to_cells(customer_rows(spark, d)), "whole_sheet").withColumn("score", F.round("score", 6)).drop("object")


# ---- headers ---------------------------------------------------------------------------------------


def conversation_rows(spark, d) -> DataFrame:
    df = table(spark, d, "conversations")
    return C.rows_from_table(df, ["conv_id", "turn", "role", "text"], F.col("turn"), "conversations", F.col("conv_id").cast("string"))


@query(
    "header_stats",
    f"""WITH f AS (SELECT conv_id::VARCHAR AS sheet, arg_min([conv_id::VARCHAR, turn::VARCHAR, role, text], turn) AS row FROM conversations GROUP BY conv_id),
k AS (SELECT *, list_filter(row, lambda v: v IS NOT NULL AND v NOT IN ('None','nan','NaN','NA','<NA>')) AS known, list_filter(row, lambda v: coalesce({s_isnum("v")}, false)) AS nums FROM f),
n AS (SELECT sheet, len(row)::INT AS n_cols, len(known)::INT AS n_nonnull, len(list_distinct(known))::INT AS n_distinct, len(nums)::INT AS n_numeric FROM k)
SELECT 'conversations' AS object, *, n_nonnull > 0 AND n_distinct::DOUBLE / n_nonnull > 0.8 AND n_nonnull::DOUBLE / n_cols > 0.6 AND n_distinct > 1 AS promoted FROM n""",
)
def header_stats(spark, d):
    return H.header_stats(conversation_rows(spark, d))


def _named_rows(df: DataFrame, key: str, name: str) -> DataFrame:
    """A table as a grid whose first row holds its column names."""
    spark, columns = df.sparkSession, df.columns
    head = spark.createDataFrame([(name, C.DEFAULT_SHEET, 0, columns)], C.ROWS_SCHEMA)
    return head.union(C.rows_from_table(df, columns, F.col(key).cast("int") + 1, name))


@query("header_promote", "SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type, p_size::VARCHAR AS p_size, " + typed("p_retailprice", "double") + " AS p_retailprice FROM part")
def header_promote(spark, d):
    return CL.clean_table(_named_rows(as_text(spark, d, "part"), "p_partkey", "part"), 6)


# ---- schemas ---------------------------------------------------------------------------------------


def _sniff_sql(name: str) -> str:
    one = []
    for k, (c, kind) in enumerate(TABLES[name]):
        v = typed(c, kind)
        best = ", ".join(f"count({s_form('v', f)})" for f, _, _ in DATE_FORMS)
        one.append(
            f"SELECT {k} AS position, '{c}' AS name, CASE WHEN count(v) = 0 THEN 'STRING' WHEN count(*) FILTER (WHERE {s_isint('v')}) = count(v) THEN 'INTEGER'"
            f" WHEN count(*) FILTER (WHERE {s_isnum('v')}) = count(v) THEN 'FLOAT' WHEN count(*) FILTER (WHERE regexp_matches(v, '^\\p{{Nd}}+$')) < count(v) AND greatest({best}) = count(v) THEN 'TIMESTAMP'"
            f" WHEN count(*) FILTER (WHERE lower(v) IN {TRUE} OR lower(v) IN {FALSE}) = count(v) THEN 'BOOLEAN' ELSE 'STRING' END AS type FROM (SELECT {v} AS v FROM {name})"
        )
    return " UNION ALL ".join(one)


def _add_sniff(name: str) -> None:
    @query(f"infer_schema_{name}", _sniff_sql(name))
    def run(spark, d):
        return I.sniffed(I.column_statistics(as_text(spark, d, name)))


for _name in TABLES:
    _add_sniff(_name)


@query(
    "schema_reconcile",
    "WITH p AS (SELECT c_custkey, [c_name, c_mktsegment, 'n' || c_nationkey] AS a, [c_mktsegment, 'n' || (c_custkey % 25), c_name || 'x'] AS b FROM customer)"
    " SELECT c_custkey, array_to_string(list_sort(list_filter(a, lambda x: list_contains(b, x))), ',') AS common,"
    " array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), ',') AS only_schema, array_to_string(list_sort(list_filter(b, lambda x: NOT list_contains(a, x))), ',') AS only_data FROM p",
)
def schema_reconcile(spark, d):
    c = table(spark, d, "customer")
    user = lambda x: F.concat(F.lit("n"), x.cast("string"))
    pairs = c.select(
        "c_custkey", F.array("c_name", "c_mktsegment", user(F.col("c_nationkey"))).alias("schema_names"),
        F.array("c_mktsegment", user(F.col("c_custkey") % 25), F.concat("c_name", F.lit("x"))).alias("columns"),
    )
    out = reconciled(pairs)
    return out.select("c_custkey", *[F.array_join(n, ",").alias(n) for n in ("common", "only_schema", "only_data")])


@query(
    "suggestion_validate",
    "SELECT * FROM (VALUES ('good', 'n_nationkey INTEGER|n_name STRING'), ('fenced', 'n_name STRING'), ('unknown_type', 'n_regionkey STRING'), ('other_names', NULL),"
    " ('bad_item', NULL), ('no_list', NULL), ('no_json', NULL)) t(name, result)",
)
def suggestion_validate(spark, d):
    columns = table(spark, d, "nation").columns
    cases = {
        "good": '[{"name": "n_nationkey", "type": "integer"}, {"name": "n_name", "type": "STRING"}, {"name": "zzz", "type": "DATE"}]',
        "fenced": '```json\n[{"name": "n_name", "type": "STRING"}]\n```',
        "unknown_type": '[{"name": "n_regionkey", "type": "MONEY"}]',
        "other_names": '[{"name": "x", "type": "STRING"}]',
        "bad_item": '[{"name": "n_name", "type": "STRING"}, {"name": "", "type": "STRING"}]',
        "no_list": '{"name": "n_name", "type": "STRING"}',
        "no_json": "n_name: STRING",
    }
    out = []
    for name, text in cases.items():
        got = I.check_suggestion(I.parse_suggestion(text), columns)
        out.append((name, "|".join(f"{f['name']} {f['type']}" for f in got) if got else None))
    return spark.createDataFrame(out, "name string, result string")


@query("sample_rows", "SELECT coalesce(o_orderkey::VARCHAR, 'null') AS o_orderkey, coalesce(o_orderstatus, 'null') AS o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE 'null' END AS p FROM orders ORDER BY orders.o_orderkey LIMIT 5")
def sample_rows(spark, d):
    return I.sample_rows(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("p")), "o_orderkey")


# ---- alignment -------------------------------------------------------------------------------------

_BAD = ("x", "", "1e3", "2.5", " 7 ", "1_000", "-0.0", "12", "99999999999999999999", "+5", "1d", "inf")
_BAD_SQL = "[" + ", ".join(f"'{b}'" for b in _BAD) + "]"


def _numbers(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    bad = F.element_at(F.array(*map(F.lit, _BAD)), (F.col("o_orderkey") % len(_BAD) + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 5 == 0, bad).otherwise(two_decimals(F.col("o_totalprice"))).alias("v"), F.when(F.col("o_orderkey") % 3 == 0, bad).otherwise(F.col("o_custkey").cast("string")).alias("w"))


NUMBERS = f"(SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN {_BAD_SQL}[(o_orderkey % {len(_BAD)} + 1)::INT] ELSE printf('%.2f', o_totalprice) END AS v, CASE WHEN o_orderkey % 3 = 0 THEN {_BAD_SQL}[(o_orderkey % {len(_BAD)} + 1)::INT] ELSE o_custkey::VARCHAR END AS w FROM orders)"


def _aligned(df: DataFrame, column: str, kind: str, as_: str = "v") -> DataFrame:
    return align(df.select("k", F.col(column).alias("v")), [{"name": "k", "type": "INTEGER"}, {"name": "v", "type": kind}]).select("k", F.col("v").alias(as_))


@query("align_integer", f"SELECT k, CASE WHEN {s_isint('w')} THEN coalesce(try_cast(CASE WHEN regexp_matches({s_strip('w')}, '^[+-]?[0-9]+$') THEN {s_strip('w')} END AS BIGINT), try_cast({s_double('w')} AS BIGINT)) END AS v FROM {NUMBERS}")
def align_integer(spark, d):
    return _aligned(_numbers(spark, d), "w", "INTEGER")


@query("align_float", f"SELECT k, {s_double('v')} AS v FROM {NUMBERS}")
def align_float(spark, d):
    return _aligned(_numbers(spark, d), "v", "FLOAT")


@query("align_decimal", f"SELECT k, CASE WHEN regexp_matches({s_strip('v')}, '{NUM}') THEN CAST(try_cast({s_strip('v')} AS DECIMAL(38, 9)) AS VARCHAR) END AS v FROM {NUMBERS}")
def align_decimal(spark, d):
    return _aligned(_numbers(spark, d), "v", "NUMERIC").withColumn("v", F.col("v").cast("string"))


_WORDS = ("true", "F", "yes", "No", " 1 ", "0.0", "maybe", "", "1.0", "nan", "Y", "2")
_WORD_SQL = "[" + ", ".join(f"'{b}'" for b in _WORDS) + "]"


@query("align_bool", f"SELECT o_orderkey AS k, CASE WHEN lower({s_strip('w')}) IN {TRUE} THEN true WHEN lower({s_strip('w')}) IN {FALSE} THEN false END AS v FROM (SELECT o_orderkey, {_WORD_SQL}[(o_orderkey % {len(_WORDS)} + 1)::INT] AS w FROM orders)")
def align_bool(spark, d):
    word = F.element_at(F.array(*map(F.lit, _WORDS)), (F.col("o_orderkey") % len(_WORDS) + 1).cast("int"))
    return _aligned(table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), word.alias("w")), "w", "BOOLEAN")


def _dates(spark, d) -> DataFrame:
    t = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(k.alias("k"), F.when(k % 7 == 0, "10:11:12").when(k % 7 == 1, "2024").when(k % 7 == 2, "n/a").otherwise(t).alias("v"), F.date_format("o_orderdate", "M/d/yyyy").alias("u"))


DATES = "(SELECT o_orderkey AS k, CASE o_orderkey % 7 WHEN 0 THEN '10:11:12' WHEN 1 THEN '2024' WHEN 2 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS v, o_orderdate FROM orders)"


@query("align_timestamp", f"SELECT k, {s_form('v', 'iso')} AS v FROM {DATES}")
def align_timestamp(spark, d):
    return _aligned(_dates(spark, d), "v", "DATETIME")


@query("align_date", f"SELECT k, CAST(o_orderdate AS DATE) AS v FROM {DATES}")
def align_date(spark, d):
    return _aligned(_dates(spark, d), "u", "DATE")


@query("align_time", f"SELECT k, strftime({s_form('v', 'iso')}, '%H:%M:%S') AS v FROM {DATES}")
def align_time(spark, d):
    return _aligned(_dates(spark, d), "v", "TIME")


@query("align_string", f"SELECT k, CASE WHEN c_name NOT IN ('<NA>', 'nan') THEN c_name END AS v FROM {TOKEN_CUSTOMERS}")
def align_string(spark, d):
    return _aligned(token_customers(spark, d), "c_name", "STRING")


@query("align_json", "SELECT event_id AS k, CASE WHEN event_id % 9 = 0 THEN NULL ELSE props END AS v FROM events")
def align_json(spark, d):
    return _aligned(table(spark, d, "events").select(F.col("event_id").alias("k"), F.when(F.col("event_id") % 9 == 0, "nan").otherwise(F.col("props")).alias("v")), "v", "JSON")


@query("align_shape", "SELECT NULL::VARCHAR AS note, n_regionkey::BIGINT AS n_regionkey, n_name FROM nation")
def align_shape(spark, d):
    return align(as_text(spark, d, "nation"), [{"name": "note", "type": "STRING"}, {"name": "n_regionkey", "type": "INTEGER"}, {"name": "n_name", "type": "STRING"}])


@query(
    "coercion_loss",
    f"""WITH c AS (SELECT 'v' AS name, count(v) AS n_before, count({s_double("v")}) AS n_after, count(*) AS n FROM {NUMBERS} UNION ALL SELECT 'w', count(w), count(*) FILTER (WHERE {s_isint("w")}), count(*) FROM {NUMBERS})
SELECT name, n_before, n_after, n_before - n_after AS n_lost, (n_before - n_after) > 0.1 * n_before AND n - n_after > 5 AS warn FROM c""",
)
def coercion_loss_query(spark, d):
    return coercion_loss(_numbers(spark, d), [{"name": "v", "type": "FLOAT"}, {"name": "w", "type": "INTEGER"}])


# ---- messages, outcomes, sink ----------------------------------------------------------------------

_MESSAGES = ('{"object_name": "a.csv", "target_dataset_id": "raw_1"}', '{"object_name": "", "target_dataset_id": "raw"}', '{"object_name": "a.csv"}', "{bad", '{"object_name": "b.xlsx", "target_dataset_id": "my-ds"}')


@query(
    "message_route",
    "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'ok' ELSE 'nack' END AS outcome, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 4 THEN 'bad dataset' ELSE 'missing name' END AS reason FROM orders",
)
def message_route(spark, d):
    line = F.element_at(F.array(*map(F.lit, _MESSAGES)), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return route(parse_messages(table(spark, d, "orders").select("o_orderkey", line.alias("value")))).select("o_orderkey", "outcome", "reason")


@query(
    "object_status",
    "WITH s AS (SELECT l_orderkey AS object, CASE WHEN l_returnflag = 'R' THEN 'failed' WHEN l_linestatus = 'F' THEN 'skipped' ELSE 'loaded' END AS outcome FROM lineitem),"
    " n AS (SELECT object, count(*) AS n_tables, count(*) FILTER (WHERE outcome = 'loaded') AS n_loaded, count(*) FILTER (WHERE outcome = 'failed') AS n_failed FROM s GROUP BY object)"
    " SELECT *, CASE WHEN n_loaded = 0 AND n_failed > 0 THEN 'failed' WHEN n_failed > 0 THEN 'partial' ELSE 'ok' END AS status, CASE WHEN n_loaded = 0 AND n_failed > 0 THEN 'nack' ELSE 'ack' END AS decision FROM n",
)
def object_status(spark, d):
    what = F.when(F.col("l_returnflag") == "R", "failed").when(F.col("l_linestatus") == "F", "skipped").otherwise("loaded")
    return settle(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("object"), what.alias("outcome")))


_NATION = [{"name": "n_nationkey", "type": "INTEGER"}, {"name": "n_name", "type": "STRING"}, {"name": "n_regionkey", "type": "INTEGER"}]
_NATION_SQL = "SELECT n_nationkey::BIGINT AS n_nationkey, n_name, n_regionkey::BIGINT AS n_regionkey FROM nation"


def _written(spark, d, *dispositions: str) -> DataFrame:
    spark.sql("CREATE DATABASE IF NOT EXISTS tabloom_queries")
    name = f"tabloom_queries.nation_{uuid.uuid4().hex[:12]}"
    for disposition in dispositions:
        load(align(as_text(spark, d, "nation"), _NATION), name, _NATION, disposition)
    return spark.table(name)


@query("write_append", f"{_NATION_SQL} UNION ALL {_NATION_SQL}")
def write_append(spark, d):
    return _written(spark, d, "WRITE_APPEND", "WRITE_APPEND")


@query("write_truncate", _NATION_SQL)
def write_truncate(spark, d):
    return _written(spark, d, "WRITE_APPEND", "WRITE_TRUNCATE")


@query("write_empty", _NATION_SQL)
def write_empty(spark, d):
    return _written(spark, d, "WRITE_EMPTY")


# ---- files -----------------------------------------------------------------------------------------


def csv_text(rows: list[list], delimiter: str = ",") -> str:
    out = io.StringIO()
    csv.writer(out, delimiter=delimiter, lineterminator="\n").writerows(rows)
    return out.getvalue()


def xlsx_bytes(sheets: dict[str, list[list]]) -> bytes:
    """A minimal workbook: numbers as numbers, other values as inline text."""
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    esc = lambda v: str(v).replace("&", "&amp;").replace("<", "&lt;")

    def cell(v) -> str:
        if v is None:
            return "<c/>"
        return f"<c><v>{v}</v></c>" if isinstance(v, int | float) else f'<c t="inlineStr"><is><t>{esc(v)}</t></is></c>'

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        names = list(sheets)
        book = "".join(f'<sheet name="{esc(n)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{book}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        for k, n in enumerate(names, 1):
            rows = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in sheets[n])
            z.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>')
    return out.getvalue()


def _file(spark, name: str, content: str | bytes) -> str:
    """A small file in a new folder that all executors can read."""
    where = f"{shared_dir(spark)}/tabloom/files-{uuid.uuid4().hex[:12]}"
    where = where if "://" in where or where.startswith("file:") else f"file://{where}"
    return put(spark, f"{where}/{name}", content.encode() if isinstance(content, str) else content)


def _nation_rows(spark, d) -> list[list]:
    return [["n_nationkey", "n_name", "n_regionkey"], *[list(r) for r in table(spark, d, "nation").orderBy("n_nationkey").collect()]]


_NATION_CELLS = (
    "SELECT sheet, row_idx, col_idx, value FROM (SELECT {0} AS sheet, unnest([0, 1, 2]) AS col_idx, 0 AS row_idx, unnest(['n_nationkey', 'n_name', 'n_regionkey']) AS value"
    " UNION ALL SELECT {0}, unnest([0, 1, 2]), n_nationkey + 1, unnest([n_nationkey::VARCHAR, n_name, n_regionkey::VARCHAR]) FROM nation)"
)


@query("read_csv_grid", _NATION_CELLS.format("'_default_'"))
def read_csv_grid(spark, d):
    from ..sources.grid import read_grid

    path = _file(spark, "nation.csv", "\n" + csv_text(_nation_rows(spark, d), ";").replace("\n", "\n   \n", 1))
    return C.to_cells(read_grid(spark, path)).drop("object")


@query("read_large_csv", _NATION_CELLS.format("'_default_'"))
def read_large_csv_query(spark, d):
    from ..sources.grid import read_object

    path = _file(spark, "nation.csv", "\n" + csv_text(_nation_rows(spark, d), "\t").replace("\n", "\n   \n", 1))
    return C.to_cells(read_object(spark, path, large_csv=0)).drop("object")


@query("read_csv_comma_fallback", "SELECT 0 AS col_idx, r_regionkey || ';' || r_name AS value, r_regionkey + 1 AS row_idx FROM region UNION ALL SELECT 0, 'k;v', 0 UNION ALL SELECT 0, '99;x;y;z', 6")
def read_csv_comma_fallback(spark, d):
    """The sniffed delimiter doesn't fit all lines, so a comma is taken."""
    from ..sources.grid import read_grid

    rows = table(spark, d, "region").orderBy("r_regionkey").select("r_regionkey", "r_name").collect()
    path = _file(spark, "region.csv", "".join(f"{k};{v}\n" for k, v in [("k", "v"), *rows, (99, "x;y;z")]))
    return C.to_cells(read_grid(spark, path)).drop("object", "sheet")


@query("read_xlsx_grid", _NATION_CELLS.format("'Nations & more'"))
def read_xlsx_grid(spark, d):
    from ..sources.grid import GridDataSource

    path = _file(spark, "book.xlsx", xlsx_bytes({"empty": [], "Nations & more": _nation_rows(spark, d)}))
    spark.dataSource.register(GridDataSource)
    return C.to_cells(spark.read.format("grid").load(path)).drop("object")


@query("read_parquet_grid", "SELECT unnest([0, 1]) AS col_idx, unnest([r_regionkey::VARCHAR, r_name]) AS value, r_regionkey AS row_idx FROM region")
def read_parquet_grid(spark, d):
    from ..sources.grid import read_object

    return C.to_cells(read_object(spark, f"{d}/region.parquet", True)).drop("object", "sheet")


@query("process_object", "SELECT 'nations' AS sheet, 'loaded' AS outcome, n_rows, k AS place FROM (SELECT count(*) AS n_rows, 1 AS k FROM nation UNION ALL SELECT count(*), 2 FROM region)")
def process_object_query(spark, d):
    regions = [["r_regionkey", "r_name"], *[list(r) for r in table(spark, d, "region").orderBy("r_regionkey").collect()]]
    path = _file(spark, "book.xlsx", xlsx_bytes({"nations": [*_nation_rows(spark, d), [None], *regions]}))
    got = process_object(spark, path, f"q_{uuid.uuid4().hex[:10]}", EngineConfig())
    rows = [(s.sheet, s.outcome, s.n_rows, int(s.table.rsplit("_", 1)[1])) for s in got]
    return spark.createDataFrame(rows, "sheet string, outcome string, n_rows long, place int")


@query("listener", "SELECT * FROM (VALUES ('book.csv', 'ok', 'ack'), ('gone.csv', 'missing', 'ack'), ('note.txt', 'unsupported', 'dead'), (NULL, 'invalid', 'nack')) t(object_name, status, decision)")
def listener(spark, d):
    from ..streaming.listener import Listener

    where = posixpath.dirname(_file(spark, "book.csv", csv_text(_nation_rows(spark, d))))
    put(spark, f"{where}/note.txt", b"no table")
    name = uuid.uuid4().hex[:10]
    lines = "".join(f'{{"object_name": "{o}", "target_dataset_id": "ds_{name}"}}\n' for o in ("book.csv", "gone.csv", "note.txt")) + "{bad\n"
    put(spark, f"{where}/messages/m.json", lines.encode())
    log = Listener(spark, EngineConfig(source_dir=where), f"log_{name}")
    log.start(f"{where}/messages", f"{where}/checkpoint", once=True).awaitTermination()
    return spark.table(log.outcomes).select("object_name", "status", "decision")


@query("numeric_dataset", "SELECT 'loaded' AS outcome, count(*) AS n_rows, 2 * count(*) AS table_rows FROM nation")
def numeric_dataset(spark, d):
    """A dataset whose name begins with a digit; the second load reports the rows of the table after it."""
    path, name = _file(spark, "nation.csv", csv_text(_nation_rows(spark, d))), f"123{uuid.uuid4().hex[:10]}"
    process_object(spark, path, name, EngineConfig())
    got = process_object(spark, path, name, EngineConfig())
    return spark.createDataFrame([(s.outcome, s.n_rows, s.table_rows) for s in got], "outcome string, n_rows long, table_rows long")


@query("replayed_load", "SELECT 'loaded' AS outcome, count(*) AS n_rows, count(*) AS in_table FROM nation")
def replayed_load(spark, d):
    """The same version of an object, delivered twice with a ledger of loads, is in the table once."""
    path, name = _file(spark, "nation.csv", csv_text(_nation_rows(spark, d))), uuid.uuid4().hex[:10]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS log_{name}")
    for _ in range(2):
        got = process_object(spark, path, f"ds_{name}", EngineConfig(), None, Ledger(spark, f"log_{name}.loads", "nation.csv", f"ds_{name}", "1"))
    n = spark.table(f"ds_{name}.nation").count()
    return spark.createDataFrame([(s.outcome, s.n_rows, n) for s in got], "outcome string, n_rows long, in_table long")


@query("schema_existing", "SELECT * FROM (VALUES (0, 'n_nationkey', 'INTEGER', 'NULLABLE'), (1, 'n_name', 'STRING', 'NULLABLE'), (2, 'n_regionkey', 'INTEGER', 'NULLABLE')) t(place, name, type, mode)")
def schema_existing(spark, d):
    """The schema of the table that is there, though the data alone would give another."""
    name = f"tabloom_queries.nation_{uuid.uuid4().hex[:12]}"
    spark.sql("CREATE DATABASE IF NOT EXISTS tabloom_queries")
    load(align(as_text(spark, d, "nation"), _NATION), name, _NATION)
    data = as_text(spark, d, "nation").withColumn("n_regionkey", F.lit("word"))
    return _fields(spark, SC.determine_schema(data, name, "existing_or_sniff"))


@query("schema_suggested", "SELECT * FROM (VALUES (0, 'n_name', 'STRING', 'NULLABLE'), (1, 'n_nationkey', 'FLOAT', 'NULLABLE')) t(place, name, type, mode)")
def schema_suggested(spark, d):
    """A suggestion within a fence, with a name that the data lack and a type that nobody knows."""

    def suggester(sample: str, columns: list[str]) -> str:
        return '```json\n[{"name": "n_name", "type": "varchar"}, {"name": "gone", "type": "STRING"}, {"name": "n_nationkey", "type": "float"}]\n```'

    return _fields(spark, SC.determine_schema(as_text(spark, d, "nation"), "tabloom_queries.none", "existing_or_suggest_or_sniff", suggester))


def _fields(spark, schema) -> DataFrame:
    return spark.createDataFrame([(k, f["name"], f["type"], f["mode"]) for k, f in enumerate(schema)], "place int, name string, type string, mode string")


# ---- flagship --------------------------------------------------------------------------------------


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables side by side on one sheet: found, given headers and types, and summed up a row each."""
    nation = _named_rows(as_text(spark, sf_dir, "nation"), "n_nationkey", "sheet")
    region = _named_rows(as_text(spark, sf_dir, "region"), "r_regionkey", "sheet")
    shift = C.to_cells(region).withColumns({"row_idx": F.col("row_idx") + 40, "col_idx": F.col("col_idx") + 6})
    cells = C.to_cells(nation).union(shift)
    rows = cells.groupBy("object", "sheet", "row_idx").agg(F.map_from_entries(F.collect_list(F.struct("col_idx", "value"))).alias("m"))
    rows = rows.select("object", "sheet", "row_idx", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.try_element_at("m", k)).alias("cells"))
    out = []
    for b in D.detect_tables(cells).orderBy("table_id").collect():
        frame = CL.clean_table(C.cut_rows(rows, b["r1"], b["c1"], b["r2"], b["c2"]), b["c2"] - b["c1"] + 1)
        schema = I.sniff_schema(frame)
        n = align(frame, schema).count()
        out.append((b["table_id"], b["r1"], b["c1"], b["r2"], b["c2"], round(b["score"], 6), n, ",".join(f["name"] for f in schema), ",".join(f["type"] for f in schema)))
    return spark.createDataFrame(out, "table_id string, r1 int, c1 int, r2 int, c2 int, score double, n_rows long, columns string, types string")


@query(
    "detect_and_type",
    "SELECT 'table_1' AS table_id, 0 AS r1, 0 AS c1, count(*)::INT AS r2, 2 AS c2, round(0.5 + 0.12 + 0.01 * ln(1 + 3 * (count(*) + 1)), 6) AS score, count(*) AS n_rows, 'n_nationkey,n_name,n_regionkey' AS columns, 'INTEGER,STRING,INTEGER' AS types FROM nation"
    " UNION ALL SELECT 'table_2', 40, 6, 40 + count(*)::INT, 7, round(0.5 + 0.12 + 0.01 * ln(1 + 2 * (count(*) + 1)), 6), count(*), 'r_regionkey,r_name', 'INTEGER,STRING' FROM region",
)
def detect_and_type(spark, d):
    return flagship(spark, d)
