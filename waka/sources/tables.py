"""Readers for the base parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Columnar scan of one base table; projections and filters reach the parquet reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    """Expose base tables as temp views for ``spark.sql`` reads."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
