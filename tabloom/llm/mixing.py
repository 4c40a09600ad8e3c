"""Mixing sources to target weights along a curriculum, in DataFrame functions only.

Targets: the sources' weights share the budget; a target stops at `most` times its source's
size and the excess is shared again by weight until none is above. Each source's documents form
a stream of words in the order of a hash; the mix takes the first target words of that stream,
repeated as often as needed. A source's weight changes over training time t from 0 to 1 as
1 + slope * (2t - 1), whose integral over 0 to 1 is 1, so its cumulative demand is
target * (t + slope * (t^2 - t)). Solving that for t gives the training position at which each
document of the stream is due, and documents are range-sorted by position.

Prefix sums over a source run in two levels: the rows are range-partitioned by source, hash and a
number of the row, sums of the partitions are added up, then rows within a partition. A range can
end anywhere, also among rows that share an identifier, so no task holds a source or such rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions, unused, word_count

#: Weights of the sources, repeating, in order of name; the slopes of their schedules likewise.
WEIGHTS, SLOPES = (5, 2, 1), (-0.5, 0.0, 0.5)


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds _mx_rank: place of each source by name, null last, without a sort in one task."""
    key = [F.col("_mx_source").isNull(), F.col("_mx_source")]
    rows = sources.repartitionByRange(max(1, shuffle_partitions(sources.sparkSession) // 4), *key).sortWithinPartitions(*key)
    rows = rows.withColumn("_mx_id", F.monotonically_increasing_id())
    rows = materialise(rows.withColumn("_mx_part", F.spark_partition_id()), "mix-sources")
    counts = rows.groupBy("_mx_part").count().collect()  # one row a partition
    before, total = {}, 0
    for part, n in sorted(map(tuple, counts)):
        before[part], total = total, total + n
    shift = F.create_map(*[F.lit(x) for kv in before.items() for x in kv]) if before else F.lit(None).cast("map<int,int>")
    return rows.withColumn("_mx_rank", F.col("_mx_id").bitwiseAND((1 << 33) - 1) + F.element_at(shift, F.col("_mx_part"))).drop("_mx_id", "_mx_part")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = 1.5, most: int = 2) -> DataFrame:
    """_mx_source, _mx_total, _mx_rank, _mx_weight, target from rows (_mx_source, _mx_total).

    Each round of the loop finds the sources that are above their limit at the present level and
    shares what is left among the others; it ends when no source joins them. A round moves four
    numbers to the driver.
    """
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.col("_mx_rank") % len(weights)).cast("int") + 1)
    src = materialise(_ranked(sizes).withColumn("_mx_weight", pick), "mix-ranked")
    total = src.agg(F.coalesce(F.sum("_mx_total"), F.lit(0))).first()[0]
    limit, level, done = most * F.col("_mx_total"), None, -1
    full = F.lit(False)
    while True:
        n, held, weight = src.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("_mx_weight"))), F.lit(0))
        ).first()
        if n == done or not weight:
            break
        done, level = n, (budget * total - held) / weight
        full = limit <= F.col("_mx_weight") * F.lit(float(level))
    goal = F.when(full, limit.cast("double")).otherwise(F.col("_mx_weight") * F.lit(float(level or 0.0)))
    return src.withColumn("target", F.least(goal, limit.cast("double")))


def _planned(rows: DataFrame, weights, slopes, budget: float, most: int) -> DataFrame:
    """Rows (_mx_ident, _mx_source, size, ...) with source_size, target, taken, passes, position, positions."""
    rows = rows.withColumn("_mx_hash", F.md5(F.coalesce(F.col("_mx_ident").cast("string"), F.lit("")).cast("binary")))
    rows = materialise(rows.withColumn("_mx_row", F.monotonically_increasing_id()), "mix-sizes")
    sizes = rows.groupBy("_mx_source").agg(F.sum("size").alias("_mx_total"))
    src = materialise(source_targets(sizes, weights, budget, most), "mix-targets")
    order = ["_mx_hash", "_mx_ident", "size", "_mx_row"]
    rows = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), "_mx_source", *order)
    rows = materialise(rows.withColumn("_mx_part", F.spark_partition_id()), "mix-ordered")

    same = lambda a, b, *names: [a[n].eqNullSafe(b[n]) for n in names]
    parts = rows.groupBy("_mx_source", "_mx_part").agg(F.sum("size").alias("_mx_sum"))
    in_order = Window.partitionBy("_mx_source").orderBy("_mx_part").rowsBetween(Window.unboundedPreceding, -1)  # no more than there are partitions
    parts = parts.withColumn("_mx_begin", F.coalesce(F.sum("_mx_sum").over(in_order), F.lit(0)))
    plan = parts.join(src, same(parts, src, "_mx_source")).select(
        parts["_mx_source"].alias("_mx_s"), parts["_mx_part"].alias("_mx_p"), "_mx_begin", F.col("_mx_total").alias("source_size"), "target", "_mx_rank"
    )
    in_part = Window.partitionBy("_mx_source", "_mx_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_mx_before", F.coalesce(F.sum("size").over(in_part), F.lit(0)))
    rows = rows.join(plan, rows["_mx_source"].eqNullSafe(plan["_mx_s"]) & (rows["_mx_part"] == plan["_mx_p"]))
    rows = rows.withColumn("_mx_at", F.col("_mx_begin") + F.col("_mx_before")).withColumn("_mx_goal", F.floor(F.col("target") + 0.5))

    def taken(k: int):
        """Words taken in pass k."""
        return F.greatest(F.lit(0), F.least(F.col("size"), F.col("_mx_goal") - k * F.col("source_size") - F.col("_mx_at")))

    slope = F.element_at(F.array(*map(F.lit, slopes)), (F.col("_mx_rank") % len(slopes)).cast("int") + 1)

    def due(k: int):
        """Training time at which the document's words of pass k begin."""
        share = F.try_divide(F.col("_mx_at") + k * F.col("source_size") if k else F.col("_mx_at"), F.col("target"))
        root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * share)
        return F.when(F.abs(slope) < 1e-9, share).otherwise((root - (1 - slope)) / (2 * slope)) + 0.0  # not -0
    rows = rows.withColumns({
        "taken": sum((taken(k) for k in range(1, most)), taken(0)).cast("long"),
        "passes": sum(((taken(k) > 0).cast("int") for k in range(1, most)), (taken(0) > 0).cast("int")),
    })
    rows = rows.withColumn("position", F.when(taken(0) > 0, due(0)))
    return rows.withColumn("positions", F.array_compact(F.array(*[F.when(taken(k) > 0, due(k)) for k in range(most)])))


def mix(docs: DataFrame, text: str = "text", ident: str = "doc_id", source: str = "source", weights=WEIGHTS, slopes=SLOPES, budget: float = 1.5, most: int = 2) -> DataFrame:
    """One row for each input row: identifier, size, source_size, target, taken, passes, position, positions.

    size: words of the text (null: 0). taken: words the mix takes of the document, repeats
    counted, at most `most` times its size; a source's taken words add up to its target, rounded.
    passes: how often the document is begun. position: training time in 0..1 of its first word
    (null when none is taken), positions that of each pass. The order within a source is that of md5(identifier), then the
    identifier, then the size; rows equal in all three are interchangeable. Null is a source of
    its own, and comes last. An empty table gives an empty result. The rows come range-sorted by position.
    """
    rows = docs.select(docs[ident].alias("_mx_ident"), docs[source].alias("_mx_source"), word_count(docs[text]).alias("size"))
    rows = _planned(rows, weights, slopes, budget, most)
    rows = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), F.col("position").asc_nulls_last(), "_mx_ident")
    rows = rows.sortWithinPartitions(F.col("position").asc_nulls_last(), "_mx_ident")
    return rows.select(F.col("_mx_ident").alias(ident), F.col("size").cast("long"), F.col("source_size").cast("long"), "target", "taken", "passes", "position", "positions")


def mixed_documents(docs: DataFrame, text: str = "text", ident: str = "doc_id", source: str = "source", weights=WEIGHTS, slopes=SLOPES, budget: float = 1.5, most: int = 2) -> DataFrame:
    """The mix itself: the input's columns, a row for each pass of a document, range-sorted by training position.

    Documents the mix takes no word of go. Texts stay whole, the last one of a source too. Rows
    that share an identifier, null included, are planned each by itself; rows equal in all columns
    are interchangeable, so one of them is put out as often as all of them are passed.
    """
    name, place = unused("_mx_copy", docs.columns), unused("_mx_position", docs.columns)
    rest = F.to_json(F.struct(*[docs[c] for c in docs.columns if c != text], docs[text].isNull().alias(unused("_mx_none", docs.columns))))
    copy = F.md5(F.concat(F.md5(F.coalesce(docs[text], F.lit("")).cast("binary")), rest).cast("binary")).alias(name)
    rows = docs.select(docs[ident].alias("_mx_ident"), docs[source].alias("_mx_source"), word_count(docs[text]).alias("size"), copy)
    plan = _planned(rows, weights, slopes, budget, most).where("passes > 0").select(name, F.explode("positions").alias(place))
    rows = docs.select("*", copy).dropDuplicates([name]).join(plan, name)
    rows = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), place, name).sortWithinPartitions(place, name)
    return rows.select(*docs.columns)
