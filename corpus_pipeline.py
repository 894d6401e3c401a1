"""A corpus pipeline of five stages: quality classifier, near-duplicates, personal data, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs. All
but the last keep the columns of `documents`. Nulls, empty texts, empty tables and further columns are as the
operators in `lakeship.llm` say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeship.llm import bpe, crf_quality, mixing, pii, simhash
from lakeship.llm.common import read_table, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return crf_quality.good_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_of_each_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts."""
    return pii.masked_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights: documents are left out or repeated."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text's token ids, with digests of them and of what they decode to."""
    return bpe.encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("tokens", tokens),
]
#: A trained classifier, hashes that DuckDB lacks and BPE are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, on the documents of `sf_dir`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
