"""Parquet table access with explicit column lists (pruned at the scan).

Every call lists the files anew: a frame that outlives an append would go on
reading the files it first saw.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import join_path


def table_path(sf_dir: str, name: str) -> str:
    return join_path(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
