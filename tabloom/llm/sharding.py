"""Sharding by Karmarkar-Karp differencing: near-equal bytes for groups that stay together.

Groups are dealt by hash into cells of bounded size. A cell starts with one partial partition
for each group (all shards empty but one) and repeatedly combines the two partial partitions
with the largest spread, the larger parts of one with the smaller parts of the other, until one
is left. The cells' partitions, of which only the part sums matter, are combined in the same
way, many at a time, level by level. Merges are kept as a tree of permutations, and walking it down gives each group its shard.

Cells that are even by themselves could not make up for a large group. So at each level the
first cells are not combined: their parts go to one last differencing by themselves, with the
groups of the first cell and all large groups. Its items get finer from level to level.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Groups in a cell, about; cells combined at once; and rows in a block of row numbers, about.
CELL_GROUPS, FAN, BLOCK_ROWS = 20_000, 256, 20_000
#: A group with more than this part of all rows is placed by a broadcast.
HOT_PARTS = 2_000


def difference(vectors: list[list[int]]) -> list[list[int]]:
    """For each partial partition (a vector of part sums) the shard that each of its parts goes to.

    All vectors have the same length k; shard 0 ends up with the smallest sum.
    """
    if not vectors:
        return []
    k = len(vectors[0])
    sums: list[list[int]] = []
    order0 = []  # part of the input vector that stands at each sorted place
    for v in vectors:
        order = sorted(range(k), key=v.__getitem__)
        order0.append(order)
        sums.append([v[p] for p in order])
    children: list[tuple[int, int, list[int]] | None] = [None] * len(sums)
    heap = [(s[0] - s[-1], i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        # Sorted place p of a (largest last) meets place k-1-p of b.
        joined = [x + y for x, y in zip(sums[a], reversed(sums[b]), strict=True)]
        order = sorted(range(k), key=joined.__getitem__)
        sums[a] = sums[b] = []  # only the newest vectors are needed
        sums.append([joined[p] for p in order])
        children.append((a, b, order))
        heapq.heappush(heap, (sums[-1][0] - sums[-1][-1], len(sums) - 1))
    out: list[list[int]] = [[]] * len(vectors)
    todo = [(len(sums) - 1, list(range(k)))]  # node, and the shard of each of its sorted places
    while todo:
        node, shard = todo.pop()
        pair = children[node]
        if pair is None:
            own = [0] * k
            for place, part in enumerate(order0[node]):
                own[part] = shard[place]
            out[node] = own
            continue
        a, b, order = pair
        at = [0] * k
        for place, p in enumerate(order):
            at[p] = shard[place]
        todo.append((a, at))
        todo.append((b, at[::-1]))
    return out


def numbered(df: DataFrame, group: str, order: list, salt, out: str, rows: int) -> DataFrame:
    """Adds out: gapless numbers from 0 within each group, without a task that holds a group.

    Rows go to blocks of their group by salt; a block begins where the counts of the earlier ones end.
    """
    blocks = max(1, math.ceil(rows / BLOCK_ROWS))
    df = df.withColumn("_nb_block", F.pmod(salt, F.lit(blocks)))
    before = Window.partitionBy(group).orderBy("_nb_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(group, "_nb_block").agg(F.count(F.lit(1)).alias("_nb_n"))
    counts = counts.withColumn("_nb_from", F.coalesce(F.sum("_nb_n").over(before), F.lit(0))).drop("_nb_n")
    df = df.withColumn("_nb_row", F.row_number().over(Window.partitionBy(group, "_nb_block").orderBy(*order)))
    df = df.join(counts, [group, "_nb_block"])
    return df.withColumn(out, F.col("_nb_from") + F.col("_nb_row") - 1).drop("_nb_block", "_nb_from", "_nb_row")


def shard_by_bytes(docs: DataFrame, shards: int = 16, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """One row for each input row: identifier, size, text_crc32, shard, slot, group_bytes.

    size: UTF-8 bytes of the text plus 1; a null text counts as an empty one. Equal texts are a
    group and share a shard, however large the group is; where one group is larger than a
    shard's even share, the others are spread evenly over what is left. slot: 0, 1, 2 ... within
    a shard, in an order that the identifiers and the input's partitions decide (rows equal in
    identifier and text are interchangeable). An empty table gives an empty result.
    """
    body = F.coalesce(docs[text], F.lit("")).cast("binary")
    rows = docs.select(
        docs[ident].alias("_sh_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.sha2(body, 256).alias("_sh_key"),
        F.spark_partition_id().alias("_sh_from"),
    )
    rows = materialise(rows, "shard-rows")
    groups = materialise(rows.groupBy("_sh_key").agg(F.sum("size").alias("_sh_bytes"), F.count(F.lit(1)).alias("_sh_n")), "shard-groups")
    total, n_rows, n_groups = groups.agg(F.coalesce(F.sum("_sh_bytes"), F.lit(0)), F.coalesce(F.sum("_sh_n"), F.lit(0)), F.count(F.lit(1))).first()
    # A group of at least an even share of what is left takes a shard for itself.
    alone, left, parts = [], total, shards
    for r in groups.orderBy(F.desc("_sh_bytes"), "_sh_key").limit(shards).collect():
        if parts == 1 or r["_sh_bytes"] * parts < left:
            break
        parts -= 1
        alone.append((r["_sh_key"], parts))
        left -= r["_sh_bytes"]
    own = docs.sparkSession.createDataFrame(alone, "_sh_key string, shard int")
    cells = max(1, math.ceil(n_groups / CELL_GROUPS))
    # At most parts * FAN groups are large; these and the groups of cell 0 are placed by themselves.
    large = F.col("_sh_bytes") > left / parts / min(cells, FAN)
    units = groups.join(F.broadcast(own), "_sh_key", "left_anti").drop("_sh_n").withColumn("_sh_cell", F.when(large, 0).otherwise(F.pmod(F.xxhash64("_sh_key"), F.lit(cells))).cast("int"))

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_sh_key")
        pdf["_sh_part"] = [own[-1] for own in difference([[0] * (parts - 1) + [s] for s in pdf["_sh_bytes"].tolist()])]
        return pdf[["_sh_key", "_sh_bytes", "_sh_cell", "_sh_part"]]

    def join_cells(pdf: pd.DataFrame) -> pd.DataFrame:
        sums: dict[int, list[int]] = {}
        for cell, part, size in zip(pdf["_sh_cell"].tolist(), pdf["_sh_part"].tolist(), pdf["_sh_bytes"].tolist(), strict=True):
            sums.setdefault(cell, [0] * parts)[part] = size
        names = sorted(sums)
        placed = dict(zip(names, difference([sums[c] for c in names]), strict=True))
        pdf["_sh_up_part"] = [placed[c][p] for c, p in zip(pdf["_sh_cell"].tolist(), pdf["_sh_part"].tolist(), strict=True)]
        return pdf[["_sh_cell", "_sh_part", "_sh_up", "_sh_up_part", "_sh_bytes"]]

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_sh_level", "_sh_cell", "_sh_part", "_sh_key"])
        pdf["shard"] = [own[-1] for own in difference([[0] * (parts - 1) + [s] for s in pdf["_sh_bytes"].tolist()])]
        return pdf[["_sh_level", "_sh_cell", "_sh_part", "_sh_key", "shard"]]

    single = units.where("_sh_cell = 0")
    items = single.select(F.lit(-1).alias("_sh_level"), "_sh_cell", F.lit(0).alias("_sh_part"), "_sh_key", "_sh_bytes")
    maps = []
    if cells > 1:
        units = units.where("_sh_cell > 0").groupBy("_sh_cell").applyInPandas(combine, "_sh_key string, _sh_bytes long, _sh_cell int, _sh_part int")
        units = materialise(units, "shard-cells")
        level = units.groupBy("_sh_cell", "_sh_part").agg(F.sum("_sh_bytes").alias("_sh_bytes"))
    # The parts of the first FAN cells are items; the others are combined in groups of FAN, and so on until none are left.
    while cells > 1:
        first = level.where(F.col("_sh_cell") < FAN)
        items = items.union(first.select(F.lit(len(maps)).alias("_sh_level"), "_sh_cell", "_sh_part", F.lit("").alias("_sh_key"), "_sh_bytes"))
        cells = math.ceil(cells / FAN)
        up = None
        if cells > 1:
            level = level.where(F.col("_sh_cell") >= FAN).withColumn("_sh_up", F.floor(F.col("_sh_cell") / FAN).cast("int"))
            level = materialise(level.groupBy("_sh_up").applyInPandas(join_cells, "_sh_cell int, _sh_part int, _sh_up int, _sh_up_part int, _sh_bytes long"), "shard-cells")
            up = level.drop("_sh_bytes")
            level = level.groupBy(F.col("_sh_up").alias("_sh_cell"), F.col("_sh_up_part").alias("_sh_part")).agg(F.sum("_sh_bytes").alias("_sh_bytes"))
        maps.append(up)
    # About CELL_GROUPS groups and, for each level, FAN * parts parts at most.
    placed = items.withColumn("_sh_up", F.lit(0)).groupBy("_sh_up").applyInPandas(place, "_sh_level int, _sh_cell int, _sh_part int, _sh_key string, shard int")
    placed = materialise(placed, "shard-items")
    found = placed.where("_sh_level = -1").select("_sh_key", "shard").union(own)
    for k, up in enumerate(maps):
        here = placed.where(F.col("_sh_level") == k).select("_sh_cell", "_sh_part", "shard")
        found = found.union(units.join(here, ["_sh_cell", "_sh_part"]).select("_sh_key", "shard"))
        if up is not None:
            units = units.join(up, ["_sh_cell", "_sh_part"]).select("_sh_key", F.col("_sh_up").alias("_sh_cell"), F.col("_sh_up_part").alias("_sh_part"))
    found = groups.join(found, "_sh_key").select("_sh_key", F.col("_sh_bytes").alias("group_bytes"), "_sh_n", "shard")
    found = materialise(found, "shard-places")
    # Groups of many rows are few (fewer than HOT_PARTS) and go to every task, so that no task gathers one.
    hot = found.where(F.col("_sh_n") > n_rows / HOT_PARTS).drop("_sh_n")
    marked = rows.join(F.broadcast(hot), "_sh_key", "left")
    rest = marked.where("shard IS NULL").drop("group_bytes", "shard").join(found.where(F.col("_sh_n") <= n_rows / HOT_PARTS).drop("_sh_n"), "_sh_key")
    rows = marked.where("shard IS NOT NULL").unionByName(rest)
    rows = numbered(rows, "shard", ["_sh_id", "text_crc32"], F.xxhash64("_sh_id", "_sh_from"), "slot", math.ceil(n_rows / shards))
    return rows.select(F.col("_sh_id").alias(ident), "size", "text_crc32", "shard", "slot", "group_bytes")
