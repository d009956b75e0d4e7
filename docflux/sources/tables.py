"""Parquet tables of a data directory, with column pruning left to Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of ``sf_dir``: one Parquet file or a folder of them."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrival(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table with ``arrival``, a struct that orders its rows as they were written: by file, then by row in it."""
    rows = table(spark, sf_dir, name)
    return rows.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("arrival"))
