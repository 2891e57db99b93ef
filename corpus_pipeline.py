"""A corpus pipeline of four stages; each stage's result is written as Parquet and read as the next one's docs.

1. quality: documents that the quality classifier rejects go
2. near-duplicates: one document of each SimHash group stays (3-word shingles, 3 bits)
3. decontamination: benchmark passages are cut out; documents that are mostly benchmark go
4. tokens: SentencePiece ids of the text
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.llm import decontaminate, pieces, quality, simhash
from shelfscope.llm.common import read_table, through_table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, shingle=3, radius=3)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"), window=10)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = pieces.encode_docs(docs.select("doc_id", "lang", "source", "text"), pieces.model_path())
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [("quality", good_quality), ("near_duplicates", without_near_copies),
          ("decontamination", without_benchmark), ("sentencepiece", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = through_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # a fitted classifier, XXH64 and SentencePiece are beyond SQL
