"""Queries over the operators: each reads its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (chat, clustering, decontaminate, embeddings, htmltext, merkle, pieces, quality, secrets, sharding, simhash,
               tokens, urls)
from .common import read_table


def op1_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.query(read_table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.query(read_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.query(read_table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.query(read_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.query(read_table(spark, sf_dir, "pages"))


def op7_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.query(read_table(spark, sf_dir, "conversations"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.query(read_table(spark, sf_dir, "pages"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.query(read_table(spark, sf_dir, "embeddings"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.query(read_table(spark, sf_dir, "documents"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.query(read_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.query(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_binary, op2_decontaminate, op3_shards, op4_simhash, op5_sentencepiece, op6_url_filter,
    op7_preference_chat, op8_quality, op9_html_extract, op10_embedding_dedup,
    op11_secret_scan, op12_centroid_clusters, op13_merkle_manifest)}
ORACLE_SQL = {"op6_url_filter": urls.ORACLE, "op7_preference_chat": chat.ORACLE, "op11_secret_scan": secrets.ORACLE,
              "op12_centroid_clusters": clustering.ORACLE, "op13_merkle_manifest": merkle.ORACLE}
