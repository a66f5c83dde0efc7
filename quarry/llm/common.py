"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a lookup table that may be broadcast; above it Spark joins by shuffle.
BROADCAST_ROWS = 1_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Two non-null longs that identify a document by id and text.

    Used to bring results back to documents: rows that repeat id and text
    share the key and have equal results, one id with several texts does not
    mix them up, and null ids join like any other.
    """
    return [F.xxhash64(F.col(id_col).cast("string")).alias("_k1"), F.xxhash64(F.lit(7), F.col(text_col)).alias("_k2")]


KEY = ["_k1", "_k2"]


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to be within ``limit``."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
