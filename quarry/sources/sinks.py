"""Sinks: split snapshots + manifest, feature spec, importances."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.digest import dataset_digest, feature_set_digest
from quarry.operators.split import SPLIT
from quarry.spec import FeatureSpec

LAYOUT = "parquet/partitioned-by-split"


def persist_split_snapshots(split_df: DataFrame, root: str, run_id: str, spec: FeatureSpec,
                            feature_table: str, feature_table_version: int | None,
                            feature_table_timestamp: str | None, extra: dict | None = None,
                            max_records_per_file: int | None = None) -> dict:
    """Write ``root/run_id=<id>/split=<name>/`` in one job, then the manifest.

    Counts and digests per split come from reading the written files back
    (one aggregate), so the manifest describes exactly what is on disk."""
    path = os.path.join(root, f"run_id={run_id}")
    w = split_df.select(*spec.training_columns, SPLIT).write.mode("overwrite").partitionBy(SPLIT)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(path)
    spark = split_df.sparkSession
    written = spark.read.parquet(path)
    stats = dataset_digest(written, spec.training_columns, group_by=[SPLIT]).collect()
    manifest = {
        "run_id": run_id,
        "feature_table": feature_table,
        "feature_table_version": feature_table_version,
        "feature_table_timestamp": feature_table_timestamp,
        "feature_set_digest": feature_set_digest(spec.features),
        "feature_columns": list(spec.features),
        "metadata_columns": list(spec.metadata),
        "target_column": spec.target,
        "split_paths": {r[SPLIT]: os.path.join(path, f"{SPLIT}={r[SPLIT]}") for r in stats},
        "split_digests": {r[SPLIT]: r["digest_sum"] for r in stats},
        "split_row_counts": {r[SPLIT]: int(r["n_rows"]) for r in stats},
        "split_file_layout": LAYOUT,
        **(extra or {}),
    }
    write_json_record(spark, manifest, os.path.join(path, "_manifest"))
    return manifest


def write_json_record(spark: SparkSession, record: dict, path: str) -> None:
    """One JSON document (sorted keys) as a one-row text file."""
    spark.createDataFrame([(json.dumps(record, sort_keys=True, default=str),)], "value string") \
         .coalesce(1).write.mode("overwrite").text(path)


def export_feature_spec(spark: SparkSession, spec: FeatureSpec, path: str) -> dict:
    rec = {"metadata_columns": list(spec.metadata), "numeric": list(spec.numeric),
           "boolean": list(spec.boolean), "categorical": list(spec.categorical),
           "feature_columns": spec.features, "target_column": spec.target,
           "feature_set_digest": feature_set_digest(spec.features)}
    write_json_record(spark, rec, path)
    return rec


def export_importances(importances: DataFrame, root: str, top_k: int = 10) -> None:
    """JSON + CSV of all importances and a top-k JSON (small: one row per
    encoded feature)."""
    ordered = importances.orderBy(F.desc("importance"), F.asc("feature"))
    ordered.coalesce(1).write.mode("overwrite").json(os.path.join(root, "feature_importance_json"))
    ordered.coalesce(1).write.mode("overwrite").option("header", True).csv(os.path.join(root, "feature_importance_csv"))
    ordered.limit(top_k).coalesce(1).write.mode("overwrite").json(os.path.join(root, "feature_importance_top"))
