"""The corpus pipeline: quality rules, near-duplicates, repeated strings, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; its result is written before the next stage begins. All but the last return the columns of ``docs``; the last adds the token
ids and whether they decode to the text. The surprising rows (nulls, empty and
very long texts, repeated rows, extra columns) are defined in the docstrings of
the operators; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from delaylake.llm import decontamination, pieces, quality, simhash, substrings
from delaylake.llm.store import stage as scratch
from delaylake.llm.store import stored

#: Fixed value: repeats of more than 50 words go. They take 6.3 bytes a word with its space in documents
#: and seldom less than five; the 400 bytes of op7 are the length of that query only.
PASSAGE_BYTES = 250


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with scratch(docs):
        return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with scratch(docs):
        return simhash.without_near_duplicates(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with scratch(docs):
        return substrings.clean(docs, PASSAGE_BYTES)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with scratch(docs):
        return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with scratch(docs):
        return pieces.encode(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("repeated strings", repeated_strings),
    ("benchmark leaks", benchmark_leaks),
    ("tokens", tokens),
]
#: No SQL: suffix sorts, similarity classes and merges cannot be put in SQL. The tests hold the operators of the
#: stages against brute force; of the whole they check columns, counts and that documents are distinct.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
