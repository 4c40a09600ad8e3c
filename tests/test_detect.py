import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabloom.operators import cells as C
from tabloom.operators.detect import detect_tables, label_distributed, label_grouped, label_mask, overlap, score_of


def grid(spark, rows, name="f", sheet="s"):
    width = max(map(len, rows))
    return spark.createDataFrame([(name, sheet, k, [*r, *[None] * (width - len(r))]) for k, r in enumerate(rows)], C.ROWS_SCHEMA)


def found(spark, rows, **options):
    out = detect_tables(C.to_cells(grid(spark, rows)), **options).orderBy("table_id").collect()
    return [((r["r1"], r["c1"], r["r2"], r["c2"]), round(r["score"], 6)) for r in out]


def csv(text):
    return [[v or None for v in line.split(",")] for line in text.split("/")]


F1 = "id,name,amt/1,ann,2.5/2,bob,3/3,cy,4"


def test_plain_table(spark):
    assert found(spark, csv(F1)) == [((0, 0, 3, 2), 0.645649)]


def test_numeric_headers(spark):
    assert found(spark, csv("2021,2022,2023/1,2,3/4,5,6")) == [((0, 0, 2, 2), 0.613026)]
    assert found(spark, csv("1,1,2/3,4,5/6,7,8")) == [((0, 0, 2, 2), 0.553026)]


def test_stacked_and_side_by_side(spark):
    assert [b for b, _ in found(spark, csv(F1) + [[None] * 3] + csv("k,v/x,y/z,w"))] == [(0, 0, 3, 2), (5, 0, 7, 1)]
    side = [["a", "b", None, "c", "d"], ["1", "2", None, "3", "4"], ["5", "6", None, "7", "8"]]
    assert sorted(b for b, _ in found(spark, side)) == [(0, 0, 2, 1), (0, 3, 2, 4)]
    corner = [["a", "b", None, None], ["1", "2", None, None], ["3", "4", None, None], [None, None, "c", "d"], [None, None, "5", "6"]]
    assert [b for b, _ in found(spark, corner)] == [(0, 0, 4, 3)]


def ring():
    g = [[None] * 7 for _ in range(7)]
    for k in range(7):
        for r, c in ((0, k), (6, k), (k, 0), (k, 6)):
            g[r][c] = f"o{r}_{c}"
    for r in range(2, 5):
        for c in range(2, 5):
            g[r][c] = f"i{r}_{c}"
    return g


def test_ring_loses_to_its_core(spark):
    assert found(spark, ring()) == [((2, 2, 4, 4), 0.643026)]
    assert round(score_of(33, 49, 0.4), 6) == 0.491998


def test_too_small_and_too_sparse(spark):
    assert found(spark, [["a"] * 5, ["b"] * 5]) == [] and found(spark, [[str(k)] for k in range(5)]) == []
    assert found(spark, [["x" if r == c else None for c in range(10)] for r in range(10)]) == []


def test_blank_words_are_no_content(spark):
    rows = csv(F1) + [["n/a", " ", "NULL"]] + csv("k,v/x,y/z,w")
    assert [b for b, _ in found(spark, rows)] == [(0, 0, 3, 2), (5, 0, 7, 1)]


def test_whole_sheet(spark):
    assert found(spark, csv(F1), mode="whole_sheet") == [((0, 0, 3, 2), 0.645649)]


def test_empty_sheet(spark):
    empty = C.to_cells(spark.createDataFrame([], C.ROWS_SCHEMA))
    for mode in ("grouped", "distributed", "whole_sheet"):
        assert detect_tables(empty, mode).collect() == []


@pytest.mark.parametrize("density", [0.15, 0.3, 0.5])
def test_both_ways_label_alike(spark, density):
    rng = np.random.default_rng(int(density * 100))
    rows = [("f", s, r, c, "v") for s in "ab" for r in range(40) for c in range(25) if rng.random() < density]
    cells = spark.createDataFrame(rows, C.CELLS_SCHEMA)
    assert sorted(label_grouped(cells).collect()) == sorted(label_distributed(cells).collect())


def flood(mask):
    seen, out = set(), []
    for start in map(tuple, np.argwhere(mask)):
        if start in seen:
            continue
        todo, own = [start], set()
        while todo:
            p = todo.pop()
            if p in own:
                continue
            own.add(p)
            todo += [(p[0] + a, p[1] + b) for a in (-1, 0, 1) for b in (-1, 0, 1) if 0 <= p[0] + a < mask.shape[0] and 0 <= p[1] + b < mask.shape[1] and mask[p[0] + a, p[1] + b]]
        seen |= own
        out.append(frozenset(own))
    return set(out)


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(0, 2**81 - 1))
def test_labels_are_components(rows, cols, bits):
    mask = np.array([[bits >> (r * 9 + c) & 1 for c in range(cols)] for r in range(rows)], bool)
    labels = label_mask(mask)
    assert ((labels > 0) == mask).all()
    assert {frozenset(map(tuple, np.argwhere(labels == k))) for k in range(1, labels.max() + 1)} == flood(mask)
    assert {frozenset((c, r) for r, c in s) for s in flood(mask)} == {frozenset(map(tuple, np.argwhere(label_mask(mask.T) == k))) for k in range(1, label_mask(mask.T).max() + 1)}


def test_large_sheets_are_labelled_over_all_tasks(spark, monkeypatch):
    from tabloom.operators import detect

    rng = np.random.default_rng(5)
    cells = [("o", s, int(r), int(c), "x") for s, n in (("a", 40), ("b", 400), ("c", 900)) for r, c in {tuple(x) for x in rng.integers(0, 40, (n, 2)).tolist()}]
    cells.append(("o", "a", 10_000_000, 2_000_000, "x"))  # far away: memory follows the cells
    df = spark.createDataFrame(cells, "object string, sheet string, row_idx int, col_idx int, value string").persist()
    want = sorted(map(tuple, label_grouped(df).collect()))
    monkeypatch.setattr(detect, "TASK_CELLS", 200)
    assert sorted(map(tuple, detect.label_by_size(df).collect())) == want == sorted(map(tuple, label_distributed(df).collect()))
    monkeypatch.setattr(detect, "TASK_CELLS", 10_000)
    assert sorted(map(tuple, detect.label_by_size(df).collect())) == want


def test_boxes_that_touch():
    assert overlap((0, 0, 2, 2), (2, 2, 4, 4)) and not overlap((0, 0, 2, 2), (3, 0, 4, 4))


def test_rectangles(spark):
    rows = grid(spark, csv(F1))
    one = C.cut_rectangle(C.to_cells(rows), 1, 1, 2, 2).orderBy("row_idx", "col_idx").collect()
    assert [(r["row_idx"], r["col_idx"], r["value"]) for r in one] == [(0, 0, "ann"), (0, 1, "2.5"), (1, 0, "bob"), (1, 1, "3")]
    assert [r["cells"] for r in C.cut_rows(rows, 1, 1, 2, 2).orderBy("row_idx").collect()] == [["ann", "2.5"], ["bob", "3"]]


def test_trim(spark):
    rows = grid(spark, [["title", None, None, None], ["a", "b", "c", "d"], [None] * 4, ["1", "2", "3", "4"], ["end", None, None, None]])
    assert [r[0] for r in C.trim_sparse_rows(rows, 0.5).select("row_idx").orderBy("row_idx").collect()] == [1, 2, 3]
    assert C.trim_sparse_rows(rows).agg(F.count(F.lit(1))).first()[0] == 5
