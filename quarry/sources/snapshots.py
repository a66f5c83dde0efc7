"""Versioned table snapshots without Delta.

Layout: ``root/data/snapshot_version=N/`` (Parquet) plus ``root/history``
(version, committed_ts, n_rows, digest_sum).  A publish writes the data
directory first and appends the history row last; readers trust the history
only, so a failed publish is invisible.  Reading a version reads that
directory alone, with the schema it was published with.  One writer per table
is assumed.

For an append-log table where each row carries the version it first appeared
in, ``read_append_log`` gives the state at version v (rows with version <= v).
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.digest import dataset_digest
from quarry.functions.scalar import iso_timestamp

VERSION_COL = "snapshot_version"
HISTORY_SCHEMA = "version long, committed_ts timestamp, n_rows long, digest_sum string"


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.data_path = os.path.join(root, "data")
        self.history_path = os.path.join(root, "history")

    def history(self) -> DataFrame:
        try:
            return self.spark.read.schema(HISTORY_SCHEMA).parquet(self.history_path)
        except Exception as exc:
            if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
                return self.spark.createDataFrame([], HISTORY_SCHEMA)
            raise

    def publish(self, df: DataFrame, digest: bool = True) -> dict:
        """Overwrite semantics: the new version holds exactly ``df`` (data and
        schema).  Returns version, row count, digest."""
        top = self.history().agg(F.max("version").alias("v")).first()["v"]
        version = 0 if top is None else int(top) + 1
        target = os.path.join(self.data_path, f"{VERSION_COL}={version}")
        df.write.mode("overwrite").parquet(target)
        written = self.spark.read.parquet(target)
        stats = dataset_digest(written).first() if digest else None
        n_rows = stats["n_rows"] if stats else written.count()
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.spark.createDataFrame(
            [(version, now, int(n_rows), stats["digest_sum"] if stats else None)], HISTORY_SCHEMA
        ).coalesce(1).write.mode("append").parquet(self.history_path)
        return {"version": version, "n_rows": int(n_rows), "committed_ts": now.isoformat()}

    def resolve(self, requested_version: int | None = None) -> tuple[int | None, str | None]:
        """(version, ISO commit time); requested must exist; newest otherwise;
        (None, None) when there is no history."""
        h = self.history()
        return resolve_version(h, requested_version)

    def read(self, version: int | None = None) -> DataFrame:
        """Snapshot ``version`` (newest when None), data and schema as published."""
        version, _ = self.resolve(version)
        if version is None:
            raise ValueError("table has no published version")
        return self.spark.read.parquet(f"{self.data_path}/{VERSION_COL}={version}")


def resolve_version_frame(history: DataFrame, requested_version: int | None = None) -> DataFrame:
    """One row (version, committed_ts as ISO string) or none."""
    if requested_version is not None:
        h = history.where(F.col("version") == F.lit(int(requested_version)))
        return h.select("version", iso_timestamp("committed_ts").alias("committed_ts"))
    best = history.agg(F.max_by(F.struct("version", "committed_ts"), F.col("version")).alias("b"))
    return best.where(F.col("b").isNotNull()).select(
        F.col("b.version").alias("version"), iso_timestamp("b.committed_ts").alias("committed_ts"))


def resolve_version(history: DataFrame, requested_version: int | None = None):
    row = resolve_version_frame(history, requested_version).first()
    if row is None:
        if requested_version is not None:
            raise ValueError(f"version {requested_version} does not exist")
        return None, None
    return int(row["version"]), row["committed_ts"]


def read_append_log(df: DataFrame, version_col: str, version: int) -> DataFrame:
    """State at ``version`` of a table whose rows carry their first version."""
    return df.where(F.col(version_col) <= F.lit(int(version)))


def append_log_history(df: DataFrame, version_col: str, ts_col: str) -> DataFrame:
    """History of an append-log table: per version, commit time = latest row
    time at that version and cumulative row count."""
    per = df.groupBy(version_col).agg(F.max(ts_col).alias("committed_ts"), F.count(F.lit(1)).alias("_n"))
    from pyspark.sql import Window
    w = Window.orderBy(version_col).rowsBetween(Window.unboundedPreceding, 0)
    return per.select(F.col(version_col).cast("long").alias("version"), "committed_ts",
                      F.sum("_n").over(w).alias("n_rows"))
