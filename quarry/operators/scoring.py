"""Batch scoring with provenance.

One lazy chain: unlabelled rows → score → threshold → class name →
provenance literals → per-row feature digest.  The sink runs one write job;
the row count comes from ``observe`` on that same job, not a second pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quarry.functions.digest import feature_set_digest, row_digest
from quarry.spec import FeatureSpec

PREDICTION_COLUMNS = [
    "prediction_timestamp", "model_name", "model_alias", "model_version", "model_source_run_id",
    "feature_table", "feature_table_version", "feature_table_timestamp", "feature_set_digest",
]


@dataclass(frozen=True)
class Provenance:
    model_name: str
    model_alias: str
    model_version: str
    model_source_run_id: str | None
    feature_table: str
    feature_table_version: int | None
    feature_table_timestamp: str | None
    prediction_timestamp: str | None = None  # None → current_timestamp()


def score_rows(unlabeled: DataFrame, spec: FeatureSpec, scorer: Callable[[DataFrame], DataFrame],
               prov: Provenance, threshold: float = 0.5, id_cols: list[str] | None = None,
               decimal_cols: dict | None = None, score_col: str = "fraud_probability") -> DataFrame:
    """Prediction rows.  ``scorer(df)`` must return ``df`` + column ``score``
    (a fitted model's ``predict_proba`` or a SQL expression)."""
    ids = id_cols or list(spec.metadata)
    digest = row_digest(unlabeled, spec.features, decimal_cols)
    base = unlabeled.withColumn("_fv_digest", digest)
    scored = scorer(base)
    ts = (F.current_timestamp() if prov.prediction_timestamp is None
          else F.to_timestamp(F.lit(prov.prediction_timestamp)))
    pred = F.col("score") >= F.lit(threshold)
    lit_str = lambda v: F.lit(None).cast("string") if v is None else F.lit(str(v))
    return scored.select(
        ts.cast("timestamp_ntz").alias("prediction_timestamp"),
        F.lit(prov.model_name).alias("model_name"),
        F.lit(prov.model_alias).alias("model_alias"),
        F.lit(str(prov.model_version)).alias("model_version"),
        lit_str(prov.model_source_run_id).alias("model_source_run_id"),
        F.lit(prov.feature_table).alias("feature_table"),
        lit_str(prov.feature_table_version).alias("feature_table_version"),
        lit_str(prov.feature_table_timestamp).alias("feature_table_timestamp"),
        F.lit(feature_set_digest(spec.features)).alias("feature_set_digest"),
        *ids,
        F.col("score").cast("double").alias(score_col),
        pred.alias("predicted_label"),
        F.when(pred, F.lit("fraud")).otherwise(F.lit("not_fraud")).alias("predicted_class"),
        F.col("_fv_digest").alias("feature_vector_digest"),
    )


def write_predictions(predictions: DataFrame, path: str, mode: str = "append",
                      fmt: str = "parquet") -> dict:
    """Write once; count through ``observe`` on the write job.  An empty input
    writes nothing and reports ``rows_written = 0``."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be append or overwrite")
    obs = Observation("scoring")
    observed = predictions.observe(obs, F.count(F.lit(1)).alias("rows"))
    if predictions.isEmpty():
        return {"rows_written": 0, "path": path}
    observed.write.mode(mode).format(fmt).save(path)
    return {"rows_written": int(obs.get["rows"]), "path": path}
