"""A corpus of documents, stage by stage: each stage's result is written as Parquet
and read again as the next one's documents.

1. language ID: documents whose language isn't recognised go; ``lang`` is what is recognised
2. near-duplicates: one document of each group of linked SimHash fingerprints stays
3. personal data: every span found is replaced by its kind
4. mixing: documents are sampled so that sources, languages and topics have their target shares
5. packing: the rest as sequences of 4,096 tokens, a row per piece
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from whlens.llm.common import table
from whlens.llm.langid import known_language
from whlens.llm.mixing import mixed
from whlens.llm.packing import pack
from whlens.llm.pii import without_personal_data
from whlens.llm.simhash import first_of_group


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return first_of_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_personal_data(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

#: No SQL: the stages train models, tokenize and pack. tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
