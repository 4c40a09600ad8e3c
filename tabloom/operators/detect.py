"""Finding tables on sheets: regions of touching cells, filters, scores, and a choice without overlap.

Two ways give the same regions, and `label_by_size` chooses between them. `label_grouped` handles a sheet a task, which is right for
workbooks. `label_distributed` is for sheets of any size: each row is cut into runs of occupied
columns, runs of neighbouring rows that touch are linked, and components are found by hooking
and pointer jumping over runs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import has_content
from ..functions.tokens import HEADER_NULLS
from ..functions.values import is_number
from ..storage import discard, materialise
from .cells import SHEET, occupied

BOX = "object string, sheet string, r1 int, c1 int, r2 int, c2 int, n_own long"
BOX_COLUMNS = ["r1", "c1", "r2", "c2"]
#: Occupied cells of a sheet that one task labels.
TASK_CELLS = 4_000_000


def runs_of(r: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first column, last column of each run of neighbouring cells; run of each cell) of distinct cells sorted by row and column."""
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(r)]]) - 1
    return r[first], c[first], c[last], np.cumsum(new) - 1


def label_runs(row: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """8-connected component of each run, named by its first run; runs are sorted by row and column.

    Runs of neighbouring rows are joined with a union-find, by two fingers that move to the right.
    Work and memory follow the runs, not the area that they span.
    """
    rows, columns, ends = row.tolist(), a.tolist(), b.tolist()
    parent = list(range(len(rows)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    k = 0
    for i, r in enumerate(rows):
        while rows[k] < r - 1 or rows[k] == r - 1 and ends[k] < columns[i] - 1:
            k += 1
        j = k
        while j < i and rows[j] == r - 1 and columns[j] <= ends[i] + 1:
            x, y = root(i), root(j)
            if x != y:
                parent[max(x, y)] = min(x, y)
            j += 1
    return np.array([root(x) for x in range(len(rows))], np.int64)


def label_mask(mask: np.ndarray) -> np.ndarray:
    """8-connected components of a boolean matrix, numbered from 1 in reading order of their first cell; 0 is blank."""
    r, c = np.nonzero(mask)
    if not len(r):
        return np.zeros(mask.shape, np.int64)
    row, a, b, run = runs_of(r, c)
    _, names = np.unique(label_runs(row, a, b), return_inverse=True)
    labels = np.zeros(mask.shape, np.int64)
    labels[r, c] = names[run] + 1
    return labels


def label_grouped(cells: DataFrame) -> DataFrame:
    """Bounding box of each component (BOX), a sheet in one task."""

    def boxes(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[["row_idx", "col_idx"]].drop_duplicates().sort_values(["row_idx", "col_idx"])
        row, a, b, _ = runs_of(own["row_idx"].to_numpy(), own["col_idx"].to_numpy())
        out = pd.DataFrame({"k": label_runs(row, a, b), "r": row, "a": a, "b": b, "n": b - a + 1})
        out = out.groupby("k").agg(r1=("r", "min"), c1=("a", "min"), r2=("r", "max"), c2=("b", "max"), n_own=("n", "sum"))
        out.insert(0, "object", pdf["object"].iloc[0])
        out.insert(1, "sheet", pdf["sheet"].iloc[0])
        return out

    return occupied(cells).select(*SHEET, "row_idx", "col_idx").groupBy(*SHEET).applyInPandas(boxes, BOX)


def row_runs(cells: DataFrame) -> DataFrame:
    """Runs of occupied columns in each row: (object, sheet, row_idx, c1, c2)."""
    row = Window.partitionBy(*SHEET, "row_idx").orderBy("col_idx")
    gap = occupied(cells).select(*SHEET, "row_idx", "col_idx").distinct().withColumn("run", F.col("col_idx") - F.row_number().over(row))
    return gap.groupBy(*SHEET, "row_idx", "run").agg(F.min("col_idx").alias("c1"), F.max("col_idx").alias("c2")).drop("run")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of edges (u, v), for nodes that have one. Rounds grow with the logarithm of the size."""
    edges = materialise(edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u != v"), "edges")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        hook = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("p"))
        up = hook.select(F.col("u").alias("p"), F.col("p").alias("q"))  # the same exchange as hook's
        parent = materialise(hook.join(up, "p").select("u", F.col("q").alias("p")), "parents")
        steps.append(parent)
        rest = edges.join(parent, "u").select(F.col("p").alias("a"), "v")
        rest = rest.join(parent.select(F.col("u").alias("v"), F.col("p").alias("b")), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
        hop = parent.select(F.col("p").alias("w")).distinct().join(parent.select(F.col("u").alias("w"), F.col("p").alias("q")), "w").where("w != q")
        done, edges = edges, materialise(rest.where("u != v").union(hop.select("w", "q")).union(hop.select("q", "w")).distinct(), "edges")
        discard(done)
    if not steps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = steps[0].select(F.col("u").alias("node"), F.col("p").alias("root"))
    for step in steps[1:]:
        out = out.join(step.select(F.col("u").alias("root"), F.col("p").alias("q")), "root", "left").select("node", F.coalesce("q", "root").alias("root"))
    return out


def label_distributed(cells: DataFrame) -> DataFrame:
    """Bounding box of each component (BOX), over runs."""
    runs = materialise(row_runs(cells).withColumn("id", F.monotonically_increasing_id()), "runs")
    below = runs.select(*SHEET, (F.col("row_idx") - 1).alias("row_idx"), F.col("c1").alias("b1"), F.col("c2").alias("b2"), F.col("id").alias("v"))
    touch = runs.join(below, [*SHEET, "row_idx"]).where((F.col("b1") <= F.col("c2") + 1) & (F.col("b2") >= F.col("c1") - 1))
    roots = connected(touch.select(F.col("id").alias("u"), "v"))
    own = runs.join(roots, runs["id"] == roots["node"], "left").withColumn("root", F.coalesce("root", "id"))
    box = own.groupBy(*SHEET, "root").agg(
        F.min("row_idx").alias("r1"), F.min("c1").alias("c1"), F.max("row_idx").alias("r2"), F.max("c2").alias("c2"), F.sum(F.col("c2") - F.col("c1") + 1).alias("n_own")
    )
    return box.drop("root")


def label_by_size(cells: DataFrame) -> DataFrame:
    """The same boxes: a sheet in one task, but for sheets with more than TASK_CELLS cells, which are labelled over all tasks."""
    large = occupied(cells).groupBy(*SHEET).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TASK_CELLS).drop("n")
    large = materialise(large, "large-sheets")
    if large.isEmpty():
        return label_grouped(cells)
    return label_grouped(cells.join(large, SHEET, "left_anti")).unionByName(label_distributed(cells.join(large, SHEET, "left_semi")))


def large_enough(boxes: DataFrame, min_rows: int = 3, min_cols: int = 2) -> DataFrame:
    return boxes.where((F.col("r2") - F.col("r1") + 1 >= min_rows) & (F.col("c2") - F.col("c1") + 1 >= min_cols))


def box_counts(boxes: DataFrame, cells: DataFrame, by_row: bool = True) -> DataFrame:
    """Adds n_cells, n_content (cells of any component in the box) and the first row's nn, d and num.

    nn: values that aren't words for missing ones (a missing cell counts, as nan); d: distinct
    values; num: numbers. Boxes of a sheet and its cells meet on the sheet and the row: a box
    gets a row for each of its rows, so the join is an equality, never a nested loop. Without
    by_row, for sheets with one box each, they meet on the sheet alone.
    """
    if by_row:
        rows = boxes.select(*SHEET, *BOX_COLUMNS, F.explode(F.sequence("r1", "r2")).alias("row_idx"))
        inside = rows.join(cells, [*SHEET, "row_idx"])
    else:
        inside = cells.join(boxes.select(*SHEET, *BOX_COLUMNS), SHEET).where(F.col("row_idx").between(F.col("r1"), F.col("r2")))
    inside = inside.where(F.col("col_idx").between(F.col("c1"), F.col("c2")))
    word = F.coalesce(F.col("value"), F.lit("nan"))
    first = F.col("row_idx") == F.col("r1")
    counts = inside.groupBy(*SHEET, *BOX_COLUMNS).agg(
        F.count_if(has_content(F.col("value"))).alias("n_content"),
        F.collect_set(F.when(first, word)).alias("_words"),
        F.count_if(first).alias("_first"),
        F.count_if(first & ~word.isin(*HEADER_NULLS)).alias("_nn"),
        F.count_if(first & F.coalesce(is_number(F.col("value")), F.lit(False))).alias("num"),
    )
    width = F.col("c2") - F.col("c1") + 1
    missing = width - F.col("_first")  # cells that a short row doesn't have
    some = (missing > 0).cast("int") * (~F.array_contains("_words", "nan")).cast("int")
    out = counts.withColumns({"n_cells": ((F.col("r2") - F.col("r1") + 1) * width).cast("long"), "nn": F.col("_nn") + missing, "d": F.size("_words") + some})
    return boxes.join(out.drop("_words", "_first", "_nn"), [*SHEET, *BOX_COLUMNS])


def candidate_score(density: Column, rows: Column, cols: Column, nn: Column, d: Column, num: Column, content: Column, min_header: float = 0.6, min_data_rows: int = 2, density_limit: float = 0.25) -> Column:
    """Score of a candidate; -1 rejects it."""
    share = lambda x: F.coalesce(F.try_divide(x, nn), F.lit(0.0))
    apart = (nn > 0) & (share(d) >= min_header * 0.8) & (d > 0)
    worded = apart & (share(num) < 0.4)
    unique = apart & ~(share(num) < 0.4) & (d == cols)
    header = F.when(worded, 0.4).when(unique, 0.3).when(apart, 0.1).otherwise(0.0)
    data_rows = rows - F.when(worded | unique, 1).otherwise(0)
    low = (content == 0) | (density < density_limit / 2) | (data_rows < min_data_rows)
    return F.when(low, -1.0).otherwise(0.5 * density + 0.3 * header + 0.01 * F.log1p(content.cast("double")))


def scored(boxes: DataFrame, cells: DataFrame, min_header: float = 0.6, min_rows: int = 3, density_limit: float = 0.25, dense_only: bool = True) -> DataFrame:
    """Boxes that are dense enough, with density and score; rejected ones are gone. dense_only is off for whole sheets."""
    out = box_counts(boxes, cells, dense_only).withColumn("density", F.col("n_content") / F.col("n_cells"))
    out = out.where(F.col("density") >= density_limit) if dense_only else out
    score = candidate_score(
        F.col("density"), F.col("r2") - F.col("r1") + 1, F.col("c2") - F.col("c1") + 1, F.col("nn"),
        F.col("d"), F.col("num"), F.col("n_content"), min_header, max(1, min_rows - 1), density_limit,
    )
    return out.withColumn("score", score).where("score > -0.5")


def overlap(a: tuple[int, int, int, int], b: tuple[int, int, int, int]) -> bool:
    return a[0] <= b[2] and b[0] <= a[2] and a[1] <= b[3] and b[1] <= a[3]


def choose(candidates: DataFrame) -> DataFrame:
    """Best first, those that touch no chosen one; table_id numbers them in that order. Ties go by (r1, c1)."""
    shape = "object string, sheet string, table_id string, r1 int, c1 int, r2 int, c2 int, n_cells long, n_nonnull long, score double"

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score", "r1", "c1"], ascending=[False, True, True], kind="stable")
        kept: list[tuple] = []
        rows = []
        for row in pdf.itertuples(index=False):
            box = (row.r1, row.c1, row.r2, row.c2)
            if not any(overlap(box, k) for k in kept):
                kept.append(box)
                rows.append((row.object, row.sheet, f"table_{len(kept)}", *box, row.n_cells, row.n_content, row.score))
        return pd.DataFrame(rows, columns=["object", "sheet", "table_id", *BOX_COLUMNS, "n_cells", "n_nonnull", "score"])

    columns = [*SHEET, *BOX_COLUMNS, "n_cells", "n_content", "score"]
    return candidates.select(*columns).groupBy(*SHEET).applyInPandas(pick, shape)


def sheet_boxes(cells: DataFrame) -> DataFrame:
    """One box a sheet, around all its cells (for sheets that hold one table)."""
    return cells.groupBy(*SHEET).agg(
        F.lit(0).alias("r1"), F.lit(0).alias("c1"), F.max("row_idx").alias("r2"), F.max("col_idx").alias("c2"), F.count_if(has_content(F.col("value"))).alias("n_own")
    )


def detect_tables(cells: DataFrame, mode: str = "by_size", min_rows: int = 3, min_cols: int = 2, density_limit: float = 0.25, min_header: float = 0.6) -> DataFrame:
    """Tables of every sheet: object, sheet, table_id, r1, c1, r2, c2, n_cells, n_nonnull, score."""
    if mode == "whole_sheet":
        boxes = large_enough(sheet_boxes(cells), min_rows, min_cols)
        return choose(scored(boxes, cells, min_header, min_rows, density_limit, dense_only=False))
    boxes = {"by_size": label_by_size, "grouped": label_grouped, "distributed": label_distributed}[mode](cells)
    return choose(scored(large_enough(boxes, min_rows, min_cols), cells, min_header, min_rows, density_limit))


def score_of(n_content: int, n_cells: int, header: float) -> float:
    """The score by hand, for tests."""
    return 0.5 * n_content / n_cells + 0.3 * header + 0.01 * math.log1p(n_content)
