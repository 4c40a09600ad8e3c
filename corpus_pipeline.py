"""A training corpus from `documents`: toxicity, exact dedup, near-dedup, mixing, encoding.

Each stage takes what its predecessor kept; between stages the rows are written as Parquet to
the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabloom.llm.bpe import bpe_roundtrip
from tabloom.llm.common import discard, materialise, scratch
from tabloom.llm.exact_dedup import exact_dedup
from tabloom.llm.mixing import mixed_documents
from tabloom.llm.near_dedup import near_dedup
from tabloom.llm.toxicity import fit, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, doesn't reject.

    A null text is scored as an empty one. Rows are judged by their text alone, so repeated rows
    stay or go together; labels without a document don't count.
    """
    return without_toxic(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal normalised texts: the one with the smallest identifier, a null one last.

    Null texts equal empty ones; of rows that repeat text and identifier one stays.
    """
    return exact_dedup(docs, carry=docs.columns).where("kept").select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest identifier.

    Null and empty texts, and rows without an identifier, are linked with nothing and stay. Rows
    that share an identifier are one document and stay or go together.
    """
    gone = near_dedup(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row for each pass of a document, in order of training position.

    A null source is one of its own. Documents without words, null texts included, are in no pass.
    Rows are planned each by itself, also where they share an identifier.
    """
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row of the mix, and the digests of ids and decoded bytes. A null text has no ids; repeated rows stay."""
    return bpe_roundtrip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixing), ("bpe", encoding)]

#: A trained classifier and BPE can't be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage's own intermediate tables, and its input, are removed when its output is written."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            docs = keep(materialise(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
