"""End-to-end batch scoring job.

resolve snapshot → resolve alias (error if unset) → unlabelled rows → model
score → threshold → provenance → feature digest → one write (append or
overwrite) → summary.  Nothing is collected; the row count comes from the
write job itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarry.operators import dataset as ds
from quarry.operators.model import FittedModel
from quarry.operators.registry import Registry
from quarry.operators.scoring import Provenance, score_rows, write_predictions
from quarry.plans.training import model_path
from quarry.sources.snapshots import SnapshotTable
from quarry.spec import FeatureSpec


@dataclass
class ScoreConfig:
    feature_table_root: str
    registry_root: str
    output_path: str
    model_name: str
    model_alias: str = "champion"
    feature_table_name: str = "feature_table"
    feature_table_version: int | None = None
    threshold: float = 0.5
    write_mode: str = "append"


def score(spark: SparkSession, spec: FeatureSpec, cfg: ScoreConfig) -> dict:
    table = SnapshotTable(spark, cfg.feature_table_root)
    version, version_ts = table.resolve(cfg.feature_table_version)
    registry = Registry(spark, cfg.registry_root)
    model_version = registry.alias_version(cfg.model_name, cfg.model_alias)
    if model_version is None:
        raise RuntimeError(f"alias {cfg.model_alias!r} of {cfg.model_name} is not set")
    model = FittedModel.load(model_path(cfg.registry_root, cfg.model_name, model_version), spec)
    run = (registry.table("model_versions")
           .where((F.col("model_name") == cfg.model_name) & (F.col("version") == model_version))
           .select("run_id").first())
    prov = Provenance(model_name=cfg.model_name, model_alias=cfg.model_alias, model_version=model_version,
                      model_source_run_id=None if run is None else run["run_id"],
                      feature_table=cfg.feature_table_name, feature_table_version=version,
                      feature_table_timestamp=version_ts)
    unlabeled = ds.unlabeled_rows(table.read(version), spec)
    preds = score_rows(unlabeled, spec, lambda df: model.predict_proba(df, "score"), prov, cfg.threshold)
    res = write_predictions(preds, cfg.output_path, cfg.write_mode)
    return {"feature_table": cfg.feature_table_name, "feature_table_version": version,
            "output_path": cfg.output_path, "rows_written": res["rows_written"],
            "model_alias": cfg.model_alias, "model_version": model_version}
