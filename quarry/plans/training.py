"""End-to-end training job.

snapshot → labelled rows → guards → split → fit (train part) → champion /
challenger on the same validation rows → split snapshots + manifest →
register version → promote → tags → run log → feature spec / importances.

Every step is a Spark job over the executors; the driver only receives
one-row metric frames, the hot-free split cut rows and fitted vocabularies.
The training rows are persisted once (the learner iterates over them).
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.digest import feature_set_digest
from quarry.operators import dataset as ds
from quarry.operators import split as sp
from quarry.operators.metrics import evaluate_binary
from quarry.operators.model import FittedModel, fit_model, importance_frame
from quarry.operators.registry import CHAMPION, PRIMARY_METRIC, Registry
from quarry.sources.sinks import export_feature_spec, export_importances, persist_split_snapshots
from quarry.sources.snapshots import SnapshotTable
from quarry.spec import FeatureSpec, check_split_fractions


@dataclass
class TrainConfig:
    feature_table_root: str
    registry_root: str
    artifacts_root: str
    model_name: str
    feature_table_name: str = "feature_table"
    feature_table_version: int | None = None
    validation_fraction: float = 0.2
    test_fraction: float = 0.1
    random_state: int = 42
    threshold: float = 0.5
    split_mode: str = "exact"  # or "stable"
    params: dict | None = None
    metric_name: str = PRIMARY_METRIC


def model_path(registry_root: str, model_name: str, version: str) -> str:
    return os.path.join(registry_root, "models", model_name, str(version))


def metrics_row(model: FittedModel, df: DataFrame, spec: FeatureSpec, threshold: float) -> dict:
    scored = model.predict_proba(df, "_score")
    r = evaluate_binary(scored, spec.target, "_score", threshold).first()
    out = {k: r[k] for k in ("average_precision", "f1", "precision", "recall")}
    if r["roc_auc"] is not None:
        out["roc_auc"] = r["roc_auc"]
    return out


def train(spark: SparkSession, spec: FeatureSpec, cfg: TrainConfig, run_id: str | None = None) -> dict:
    check_split_fractions(cfg.validation_fraction, cfg.test_fraction)
    run_id = run_id or uuid.uuid4().hex
    table = SnapshotTable(spark, cfg.feature_table_root)
    version, version_ts = table.resolve(cfg.feature_table_version)
    snapshot = table.read(version)
    labeled = ds.labeled_rows(snapshot, spec)
    ds.require_rows(labeled, "training")
    ds.require_two_classes(labeled, spec.target)

    id_col = spec.metadata[0]
    if cfg.split_mode == "stable":
        split = sp.stable_split(labeled, id_col, cfg.validation_fraction, cfg.test_fraction, cfg.random_state)
    else:
        split = sp.stratified_split(labeled, id_col, spec.target, cfg.validation_fraction, cfg.test_fraction,
                                    cfg.random_state)
    # materialise the split once; the three parts and the snapshot write reuse it
    split = split.persist(StorageLevel.MEMORY_AND_DISK)
    train_df = sp.split_part(split, "train", cfg.test_fraction)
    valid_df = sp.split_part(split, "validation", cfg.test_fraction)

    challenger = fit_model(train_df, spec, cfg.params)
    challenger_metrics = metrics_row(challenger, valid_df, spec, cfg.threshold)

    registry = Registry(spark, cfg.registry_root)
    champion_version = registry.alias_version(cfg.model_name, CHAMPION)
    champion_metrics = None
    if champion_version is not None:
        champion = FittedModel.load(model_path(cfg.registry_root, cfg.model_name, champion_version), spec)
        champion_metrics = metrics_row(champion, valid_df, spec, cfg.threshold)

    manifest = persist_split_snapshots(
        split, os.path.join(cfg.artifacts_root, "splits"), run_id, spec, cfg.feature_table_name, version, version_ts,
        extra={"registered_model_name": cfg.model_name, "validation_fraction": cfg.validation_fraction,
               "test_fraction": cfg.test_fraction, "random_state": cfg.random_state,
               "test_is_validation": cfg.test_fraction == 0, "split_mode": cfg.split_mode})

    new_version = registry.register_version(cfg.model_name, run_id)
    challenger.save(model_path(cfg.registry_root, cfg.model_name, new_version))
    decision = registry.promote_if_better(
        cfg.model_name, new_version, cfg.metric_name, challenger_metrics.get(cfg.metric_name),
        None if champion_metrics is None else champion_metrics.get(cfg.metric_name))
    registry.set_tags(cfg.model_name, new_version, {
        "run_id": run_id, "feature_table": cfg.feature_table_name, "feature_table_version": version,
        "feature_table_timestamp": version_ts, "feature_set_digest": feature_set_digest(spec.features),
        "promoted": decision["promoted"], "metric_name": cfg.metric_name,
        **{f"challenger_{k}": v for k, v in challenger_metrics.items()},
        **({f"champion_{k}": v for k, v in champion_metrics.items()} if champion_metrics else {}),
    })
    registry.log_run(run_id, "params", {**(challenger.params or {}), "threshold": cfg.threshold})
    registry.log_run(run_id, "metrics", {**{f"challenger_{k}": v for k, v in challenger_metrics.items()},
                                         **({f"champion_{k}": v for k, v in champion_metrics.items()}
                                            if champion_metrics else {})})
    registry.log_run(run_id, "inputs", {f"{k}_rows": n for k, n in manifest["split_row_counts"].items()})
    art = os.path.join(cfg.artifacts_root, "runs", run_id)
    export_feature_spec(spark, spec, os.path.join(art, "feature_spec"))
    export_importances(importance_frame(challenger, spark), art)
    split.unpersist()
    return {"run_id": run_id, "feature_table_version": version, "model_name": cfg.model_name,
            "model_version": new_version, "promoted": decision["promoted"],
            "champion_version_before": decision["champion_version"], "split_row_counts": manifest["split_row_counts"],
            "challenger_metrics": challenger_metrics, "champion_metrics": champion_metrics}
