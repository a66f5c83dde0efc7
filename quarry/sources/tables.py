"""Readers for the driver tables and the fixture views built on them.

Every view is a lazy projection over a Parquet scan, so Catalyst prunes
columns and pushes filters into the reader.  Derived inputs (nullable values,
positions, per-row k, deterministic score and truth, label delay, table
versions) use the same expressions as the DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet reader for a driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- derived inputs (identical expressions in the oracle SQL) -------------

def nullable_value(id_col: str = "event_id", value_col: str = "value") -> Column:
    """NULL for every 7th id: the test tables hold no NULLs."""
    return F.when(F.col(id_col) % 7 == 0, F.lit(None).cast("double")).otherwise(F.col(value_col))


def position_lat(id_col: str = "event_id") -> Column:
    return F.lit(-33.0) + (F.col(id_col) * 7919 % 3200) / F.lit(1e2)


def position_lon(id_col: str = "event_id") -> Column:
    return F.lit(-73.0) + (F.col(id_col) * 104729 % 3900) / F.lit(1e2)


def per_row_k(id_col: str = "event_id") -> Column:
    return (F.lit(1) + F.col(id_col) % 12).cast("int")


def deterministic_score(value_col: str = "value", centre: float = 40.0,
                        scale: float = 30.0) -> Column:
    """round(1/(1+exp(-(v-centre)/scale)), 3): a score with ties."""
    z = -(F.col(value_col) - F.lit(centre)) / F.lit(scale)
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(z)), 3)


def deterministic_truth(type_col: str = "event_type") -> Column:
    return F.col(type_col).isin("error", "purchase")


# ---- fixture views --------------------------------------------------------

def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a transaction stream: one row per event."""
    return read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", "event_type", "value")


def transactions_with_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).withColumns({
        "lat": position_lat(), "lon": position_lon()})


def order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a second stream with tied (customer, date) timestamps."""
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")


#: Amount that stands for a corrupt value; level that later orders are lifted by, and from when.
ABSURD, LEVEL, LIFTED_FROM = 1e17, 1e6, "1995-01-01 00:00:00"


def shifted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose ``amount`` jumps to another level at a date, with a corrupt value every 97 keys."""
    lifted = F.when(F.col("o_orderdate") >= F.lit(LIFTED_FROM).cast("timestamp_ntz"), F.lit(LEVEL)).otherwise(F.lit(0.0))
    return order_stream(spark, sf_dir).withColumn(
        "amount", F.when(F.col("o_orderkey") % 97 == 0, F.lit(ABSURD)).otherwise(F.col("o_totalprice") + lifted))


def wide_k(id_col: str = "o_orderkey") -> Column:
    """k from 1 to 40, and a million for every 50th id."""
    return F.when(F.col(id_col) % 50 == 0, F.lit(1_000_000)).otherwise((F.lit(1) + F.col(id_col) % 40).cast("int"))


def gappy(col: str, every: int, id_col: str = "o_orderkey") -> Column:
    """``col``, NULL for every ``every``-th id."""
    return F.when(F.col(id_col) % every != 0, F.col(col))


def label_cutoff(id_col: str = "o_orderkey") -> Column:
    """When a row's labels are gathered: from 100 days before the order to 499 after it; NULL for every 11th id."""
    days = (F.col(id_col) * 13 % 600 - 100).cast("int")
    return F.when(F.col(id_col) % 11 != 0, F.col("o_orderdate") + F.make_dt_interval(days=days))


def documents_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⟕ labels: the feature table with a nullable label.

    Only the narrow columns are read (the ``text`` column is pruned).
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").withColumn("label", F.col("quality").cast("int")).drop("quality")


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with the deterministic score and binary truth used by metrics."""
    return transactions(spark, sf_dir).select(
        "event_id", "user_id", "ts", "value",
        deterministic_score().alias("score"),
        deterministic_truth().cast("int").alias("truth"))
