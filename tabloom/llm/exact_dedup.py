"""Exact dedup by a distributed content sort, in DataFrame functions only.

Sampled splitters cut the order of the normalised bytes into ranges, each a partition. A splitter
holds leading bytes; where several splitters share theirs, a second sample finds splitters with
far longer leading bytes inside that prefix. Texts that agree in these too are told apart by
digest, and equal texts by identifier and input partition, so that a range can end anywhere, also
within a group of copies. Each range is sorted externally by the whole normalised bytes, which
puts equal texts next to each other, and every row is compared in full with its neighbour. A
group within which a range ends continues in the next one; there is at most one such group a
splitter, and their partial results (a minimum and a count for each range) are merged by the
whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, materialise, shuffle_partitions

#: Ranges for each shuffle partition, and sampled rows for each range; leading characters of a splitter, and of those within a prefix that has several.
RANGES_PER_PARTITION, SAMPLES_PER_RANGE, LEADING, LEADING_LONG = 2, 16, 32, 512
#: What a row counts besides its text, when ranges are made equal.
ROW_BYTES = 128


def normalise(text: Column) -> Column:
    """Null counts as empty; each run of white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS, " ")


def _begin(characters: int) -> Column:
    """Leading characters and digest; no normalised text holds the tab that ends them, so equal texts alone share this."""
    return F.concat(F.left("_xd_norm", F.lit(characters)), F.lit("\t"), "_xd_sha", F.lit("\t"))


def _with_key(df: DataFrame, text: str, ident: str) -> DataFrame:
    """_xd_norm and _xd_sha: normalised text and its digest. _xd_tie: tells rows of equal texts apart, and even equal rows of several partitions."""
    df = df.withColumn("_xd_norm", normalise(F.col(text)))
    df = df.withColumn("_xd_sha", F.sha2(F.col("_xd_norm").cast("binary"), 256))
    return df.withColumn("_xd_tie", F.lpad(F.hex(F.xxhash64(F.col(ident), F.spark_partition_id())), 16, "0"))


def _every(places: DataFrame, step: float) -> DataFrame:
    """Of the sampled places (_xd_place with _xd_weight), in order, those at which the sum of weights passes a multiple of step. A sample is of bounded size."""
    so_far = Window.partitionBy(F.lit(0)).orderBy("_xd_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = places.withColumn("_xd_sum", F.sum("_xd_weight").over(so_far))
    return places.where(F.floor(F.col("_xd_sum") / step) > F.floor((F.col("_xd_sum") - F.col("_xd_weight")) / step))


def splitters(docs: DataFrame, text: str, ident: str, ranges: int) -> tuple[list[str], list[str]]:
    """(about `ranges` boundaries in order, the prefixes with boundaries of LEADING_LONG characters).

    The driver gets a string a range: at most some hundred bytes, or LEADING_LONG characters.
    """
    share = min(1.0, SAMPLES_PER_RANGE * ranges / max(1, docs.count()))
    sample = docs.select(ident, text).sample(share, seed=11) if share < 1 else docs.select(ident, text)
    sample = _with_key(sample, text, ident).withColumns({"_xd_lead": F.left("_xd_norm", F.lit(LEADING)), "_xd_weight": F.octet_length("_xd_norm") + ROW_BYTES})
    short = materialise(sample.select("_xd_lead", "_xd_weight", F.concat(_begin(LEADING), "_xd_tie").alias("_xd_place")), "exact-sample")
    step = max(1, (short.agg(F.sum("_xd_weight")).first()[0] or 0) / ranges)
    found = [tuple(r) for r in _every(short, step).select("_xd_lead", "_xd_place").collect()]
    counts: dict[str, int] = {}
    for lead, _ in found:
        counts[lead] = counts.get(lead, 0) + 1
    long = sorted(lead for lead, n in counts.items() if n > 1)
    bounds = {place for lead, place in found if counts[lead] == 1}
    if long:
        few = docs.sparkSession.createDataFrame([(x,) for x in long], "_xd_lead string")
        places = sample.join(F.broadcast(few), "_xd_lead").select("_xd_weight", F.concat(_begin(LEADING_LONG), "_xd_tie").alias("_xd_place"))
        bounds.update(r["_xd_place"] for r in _every(places, step).collect())
    return sorted(bounds, key=lambda s: s.encode()), long


def exact_dedup(docs: DataFrame, text: str = "text", ident: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """One row for each input row: the carried columns and keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after normalise(). Of equal texts the row with the smallest
    identifier stays; keep_id is its identifier. Null texts equal empty ones. A null identifier
    comes last, so it stays only if its group has no other. Of rows that repeat text and
    identifier exactly one is kept. carry: columns to pass on (default: the identifier); those
    named like a result column are replaced. An empty table gives an empty result.
    """
    spark, carry = docs.sparkSession, [ident] if carry is None else carry
    bounds, long = splitters(docs, text, ident, RANGES_PER_PARTITION * shuffle_partitions(spark))
    # The caller's columns go by numbers, so that none of them clashes with a name here.
    safe = {c: f"_xd_c{k}" for k, c in enumerate(dict.fromkeys([ident, text, *carry]))}
    given = docs.select(*[docs[c].alias(s) for c, s in safe.items()])
    names, ident, text, carry = carry, safe[ident], safe[text], [safe[c] for c in carry]
    rows = _with_key(given, text, ident)
    begin = _begin(LEADING)
    if long:  # fewer than there are ranges
        few = spark.createDataFrame([(x, True) for x in long], "_xd_lead string, _xd_long boolean")
        rows = rows.withColumn("_xd_lead", F.left("_xd_norm", F.lit(LEADING))).join(F.broadcast(few), "_xd_lead", "left").drop("_xd_lead")
        begin = F.when(F.col("_xd_long"), _begin(LEADING_LONG)).otherwise(begin)
    rows = rows.withColumn("_xd_key", begin).withColumn("_xd_place", F.concat("_xd_key", "_xd_tie"))
    table = F.split(F.lit("\n".join(bounds)), "\n")
    steps = [1 << k for k in reversed(range(max(1, len(bounds).bit_length())))]
    found = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda low, step: F.when(F.get(table, low + step - 1) <= F.col("_xd_place"), low + step).otherwise(low),
    )
    rows = rows.withColumn("_xd_range", found if bounds else F.lit(0))
    on_edge = [F.coalesce(F.get(table, F.col("_xd_range") + k).startswith(F.col("_xd_key")), F.lit(False)) for k in (-1, 0)]
    rows = rows.withColumn("_xd_edge", on_edge[0] | on_edge[1])
    rows = rows.drop("_xd_place", "_xd_key", "_xd_tie", "_xd_long", *(["_xd_norm"] if text in carry else [text]))
    rows = rows.repartitionById(len(bounds) + 1, "_xd_range")  # a range a task

    whole = normalise(F.col(text)) if text in carry else F.col("_xd_norm")
    sort = Window.partitionBy("_xd_range").orderBy(whole, F.col(ident).asc_nulls_last())
    before = F.lag(text if text in carry else "_xd_norm").over(sort)
    same = F.lag(F.lit(True), 1, False).over(sort) & (normalise(before) == whole if text in carry else before == whole)
    rows = rows.withColumn("_xd_new", ~same)
    rows = rows.withColumn("_xd_whole", F.when(F.col("_xd_edge") & F.col("_xd_new"), whole))
    so_far = sort.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({
        "_xd_run": F.sum(F.col("_xd_new").cast("long")).over(so_far),
        "_xd_keep": F.last(F.when(F.col("_xd_new"), F.struct(F.col(ident).alias("id"))), ignorenulls=True).over(so_far),
    })
    rows = rows.withColumn("_xd_size", F.count(F.lit(1)).over(Window.partitionBy("_xd_range", "_xd_run")))
    rows = materialise(rows.drop("_xd_norm"), "exact-dedup")

    # Smallest first: a row with an identifier before one without, then the lower range.
    first = F.struct(F.col("_xd_keep.id").isNull().alias("none"), F.col("_xd_keep.id").alias("id"), F.col("_xd_range").alias("range"))
    edges = rows.where("_xd_whole IS NOT NULL").groupBy("_xd_whole")
    edges = edges.agg(F.min(first).alias("_xd_first"), F.sum("_xd_size").alias("_xd_total"), F.collect_list(F.struct("_xd_range", "_xd_run")).alias("_xd_in"))
    edges = edges.select("_xd_first", "_xd_total", F.inline("_xd_in"))
    rows = rows.join(F.broadcast(edges), ["_xd_range", "_xd_run"], "left")  # at most two small rows a range
    here = F.col("_xd_first").isNull() | (first.eqNullSafe(F.col("_xd_first")))
    return rows.select(
        *[F.col(s).alias(c) for c, s in zip(names, carry, strict=True) if c not in ("keep_id", "group_size", "kept", "text_sha256")],
        F.when(F.col("_xd_first").isNull(), F.col("_xd_keep.id")).otherwise(F.col("_xd_first.id")).alias("keep_id"),
        F.coalesce("_xd_total", "_xd_size").cast("long").alias("group_size"),
        (F.col("_xd_new") & here).alias("kept"),
        F.col("_xd_sha").alias("text_sha256"),
    )
