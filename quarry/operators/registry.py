"""Model lifecycle as append-only tables.

Tables (all append-only; current state = latest event per key):

* ``model_versions(model_name, version, run_id, created_ts)``
* ``alias_events(model_name, alias, version, event_ts, seq)``
* ``tag_events(model_name, version, key, value, event_ts, seq)``
* ``promotion_log(model_name, metric_name, challenger_version, challenger_score,
  champion_version, champion_score, promoted, decided_ts)``
* ``run_log(run_id, kind, key, value)``

Semantics kept from the reference: no champion → promote; otherwise strict
``>`` on the chosen metric (ties keep the champion); the ``challenger`` alias
is always moved, ``champion`` only on promotion; a NULL challenger score never
promotes.  A missing champion is an absent row, never a swallowed error.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.metrics import attach_row

CHAMPION = "champion"
CHALLENGER = "challenger"
PRIMARY_METRIC = "average_precision"

SCHEMAS = {
    "model_versions": "model_name string, version string, run_id string, created_ts timestamp",
    "alias_events": "model_name string, alias string, version string, event_ts timestamp, seq long",
    "tag_events": "model_name string, version string, key string, value string, event_ts timestamp, seq long",
    "promotion_log": ("model_name string, metric_name string, challenger_version string, "
                      "challenger_score double, champion_version string, champion_score double, "
                      "promoted boolean, decided_ts timestamp"),
    "run_log": "run_id string, kind string, key string, value string",
}


def current_aliases(alias_events: DataFrame) -> DataFrame:
    """(model_name, alias, version) for the latest event per alias."""
    return (alias_events.groupBy("model_name", "alias")
            .agg(F.max_by("version", F.struct("event_ts", "seq")).alias("version")))


def current_tags(tag_events: DataFrame) -> DataFrame:
    return (tag_events.groupBy("model_name", "version", "key")
            .agg(F.max_by("value", F.struct("event_ts", "seq")).alias("value")))


def version_for_run(model_versions: DataFrame) -> DataFrame:
    """Highest version (numeric order, not string order) per (model, run)."""
    return (model_versions.groupBy("model_name", "run_id")
            .agg(F.max(F.col("version").cast("long")).alias("version")))


def promoted(challenger_score: Column, champion_score: Column) -> Column:
    """The promotion rule: a scored challenger wins against no champion score or a strictly lower one."""
    return challenger_score.isNotNull() & (champion_score.isNull() | F.coalesce(challenger_score > champion_score, F.lit(False)))


def compare_scores(metrics: DataFrame, metric_name: str = PRIMARY_METRIC) -> DataFrame:
    """From a frame with ``role`` in (challenger, champion) and metric columns
    computed over the same rows, one decision row."""
    ch = metrics.where(F.col("role") == CHALLENGER).select(F.col(metric_name).alias("challenger_score"))
    cp = metrics.where(F.col("role") == CHAMPION).select(F.col(metric_name).alias("champion_score"))
    both = attach_row(ch, cp.agg(F.max("champion_score").alias("champion_score")))
    return both.select(F.lit(metric_name).alias("metric_name"), "challenger_score", "champion_score",
                       promoted(F.col("challenger_score"), F.col("champion_score")).alias("promoted"))


def promotion_gate(challenger: DataFrame, champion: DataFrame, min_accuracy_gain: float = 0.002,
                   max_log_loss_increase: float = 0.2) -> DataFrame:
    """Both inputs: one row with ``accuracy`` and ``log_loss``."""
    c = challenger.select(F.col("accuracy").alias("ch_acc"), F.col("log_loss").alias("ch_ll"))
    p = champion.select(F.col("accuracy").alias("cp_acc"), F.col("log_loss").alias("cp_ll"))
    j = attach_row(c, p)
    gain = F.col("ch_acc") - F.col("cp_acc")
    ll_inc = F.col("ch_ll") - F.col("cp_ll")
    return j.select(gain.alias("accuracy_gain"), ll_inc.alias("log_loss_increase"),
                    (gain >= F.lit(min_accuracy_gain)).alias("accuracy_ok"),
                    (ll_inc <= F.lit(max_log_loss_increase)).alias("log_loss_ok"),
                    ((gain >= F.lit(min_accuracy_gain)) & (ll_inc <= F.lit(max_log_loss_increase))).alias("promote"))


class Registry:
    """Append-only registry tables stored as Parquet under ``root``.

    Single writer per model is assumed (as for the snapshot store)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def table(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(self._path(name))
        except Exception as exc:  # no file yet → empty table
            if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
                return self.spark.createDataFrame([], SCHEMAS[name])
            raise

    def append(self, name: str, rows: list[tuple]) -> None:
        if rows:
            self.spark.createDataFrame(rows, SCHEMAS[name]).write.mode("append").parquet(self._path(name))

    def _now(self):
        import datetime as dt
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def _next_seq(self, name: str) -> int:
        r = self.table(name).agg(F.max("seq").alias("s")).first()["s"]
        return 0 if r is None else int(r) + 1

    def register_version(self, model_name: str, run_id: str) -> str:
        """Next version number for the model (idempotent per run)."""
        mv = self.table("model_versions").where(F.col("model_name") == model_name)
        existing = mv.where(F.col("run_id") == run_id).agg(F.max(F.col("version").cast("long")).alias("v")).first()["v"]
        if existing is not None:
            return str(existing)
        top = mv.agg(F.max(F.col("version").cast("long")).alias("v")).first()["v"]
        version = str(1 if top is None else int(top) + 1)
        self.append("model_versions", [(model_name, version, run_id, self._now())])
        return version

    def version_for_run(self, model_name: str, run_id: str) -> str:
        r = (version_for_run(self.table("model_versions"))
             .where((F.col("model_name") == model_name) & (F.col("run_id") == run_id)).first())
        if r is None:
            raise RuntimeError(f"no registered version of {model_name} for run {run_id}")
        return str(r["version"])

    def alias_version(self, model_name: str, alias: str) -> str | None:
        r = (current_aliases(self.table("alias_events"))
             .where((F.col("model_name") == model_name) & (F.col("alias") == alias)).first())
        return None if r is None else r["version"]

    def set_alias(self, model_name: str, alias: str, version: str) -> None:
        self.append("alias_events", [(model_name, alias, str(version), self._now(), self._next_seq("alias_events"))])

    def set_tags(self, model_name: str, version: str, tags: dict) -> None:
        seq = self._next_seq("tag_events")
        now = self._now()
        self.append("tag_events", [(model_name, str(version), k, str(v), now, seq + i)
                                   for i, (k, v) in enumerate(tags.items())])

    def promote_if_better(self, model_name: str, challenger_version: str, metric_name: str,
                          challenger_score, champion_score) -> dict:
        """Always set ``challenger``; set ``champion`` iff promoted."""
        previous = self.alias_version(model_name, CHAMPION)
        self.set_alias(model_name, CHALLENGER, challenger_version)
        scores = [F.lit(x).cast("double") for x in (challenger_score, champion_score)]
        wins = bool(self.spark.range(1).select(promoted(*scores)).first()[0])
        if wins:
            self.set_alias(model_name, CHAMPION, challenger_version)
        rec = {"model_name": model_name, "metric_name": metric_name,
               "challenger_version": str(challenger_version), "challenger_score": challenger_score,
               "champion_version": previous, "champion_score": champion_score, "promoted": wins}
        self.append("promotion_log", [(model_name, metric_name, str(challenger_version),
                                       None if challenger_score is None else float(challenger_score),
                                       previous, None if champion_score is None else float(champion_score),
                                       wins, self._now())])
        return rec

    def log_run(self, run_id: str, kind: str, items: dict) -> None:
        self.append("run_log", [(run_id, kind, str(k), str(v)) for k, v in items.items()])
