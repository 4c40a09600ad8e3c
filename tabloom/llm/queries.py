"""Queries opN_<name>: each operator over its whole table, with the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(_documents(spark, sf_dir))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM d
"""


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_dedup

    return near_dedup(_documents(spark, sf_dir), words=3, percent=85)


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) >= 3 THEN [array_to_string(words[i:i + 2], ' ') for i in range(1, len(words) - 1)]
                               WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS inter FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * inter >= 85 * (a.size + b.size - inter)),
r AS (SELECT doc_id AS u, doc_id AS c FROM documents UNION SELECT e.v, r.c FROM r JOIN e ON r.u = e.u),
m AS (SELECT u, min(c) AS c FROM r GROUP BY u)
SELECT d.doc_id, coalesce(n.size, 0)::BIGINT AS n_shingles, m.c AS component_id, m.c = d.doc_id AS kept
FROM documents d JOIN m ON m.u = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_count import token_counts

    return token_counts(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import secret_spans

    return secret_spans(_documents(spark, sf_dir))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import suffix_dedup

    return suffix_dedup(_documents(spark, sf_dir))


def op10_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import bpe_roundtrip

    return bpe_roundtrip(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .mixing import mix

    return mix(_documents(spark, sf_dir)).withColumn("position", F.round("position", 9)).drop("positions")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS k, sum(source_size) OVER () AS total FROM s),
w AS (SELECT *, [5, 2, 1][(k % 3 + 1)::INT] AS weight, [-0.5, 0.0, 0.5][(k % 3 + 1)::INT]::DOUBLE AS slope FROM r),
o AS (
  SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / weight, k) AS place, coalesce(sum(2 * source_size) OVER before, 0) AS held, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rest
  FROM w WINDOW before AS (ORDER BY 2.0 * source_size / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (1.5::DOUBLE * total - held) / rest AS level FROM o),
t AS (
  SELECT *, CASE WHEN 2 * source_size <= weight * level THEN (2 * source_size)::DOUBLE
            ELSE weight * (SELECT arg_min(level, place) FROM l WHERE 2 * source_size > weight * level) END AS target FROM l),
c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.slope, floor(t.target + 0.5)::BIGINT AS goal,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS done_
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, greatest(0, least(size, goal - done_)) AS one, greatest(0, least(size, goal - source_size - done_)) AS two FROM c)
SELECT doc_id, size, source_size, target, (one + two)::BIGINT AS taken, ((one > 0)::INT + (two > 0)::INT)::INT AS passes,
       CASE WHEN one + two > 0 THEN round(CASE WHEN slope = 0 THEN done_ / target
            ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * (done_ / target)) - (1 - slope)) / (2 * slope) END, 9) + 0.0 END AS position
FROM k
"""


def op6_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mpeg_audio import mpeg_column

    return mpeg_column(_documents(spark, sf_dir))


def op7_shard_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .sharding import shard_by_bytes

    out = shard_by_bytes(_documents(spark, sf_dir), 16)
    return out.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, score_documents

    docs = _documents(spark, sf_dir)
    return score_documents(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_near_dedup": op2_near_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_secret_spans": op4_secret_spans,
    "op5_source_mix": op5_source_mix,
    "op6_mpeg_audio": op6_mpeg_audio,
    "op7_shard_bytes": op7_shard_bytes,
    "op8_toxicity": op8_toxicity,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_bpe_roundtrip": op10_bpe_roundtrip,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": OP1_SQL,
    "op2_near_dedup": OP2_SQL,
    "op5_source_mix": OP5_SQL,
}
