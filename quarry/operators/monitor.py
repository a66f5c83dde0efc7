"""Monitoring: prediction volume, performance once labels arrive, feature
profiles, drift, retraining trigger, lookups (A10–A13, A15, J2, J3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.metrics import attach_row, evaluate_binary

# Retraining defaults of the reference configuration (fixed values).
MIN_NEW_LABELS = 30
DRIFT_THRESHOLD = 0.2
PERFORMANCE_FLOOR = 0.68
PSI_EPS = 1e-6


def prediction_monitor(predictions: DataFrame, version_col: str = "model_version",
                       score_col: str = "score", ts_col: str = "prediction_timestamp") -> DataFrame:
    return (predictions.groupBy(version_col)
            .agg(F.count(F.lit(1)).alias("n_predictions"), F.avg(score_col).alias("mean_score"),
                 F.max(ts_col).alias("last_prediction_ts")))


def join_truth(predictions: DataFrame, truth: DataFrame, id_cols: list[str], how: str = "left") -> DataFrame:
    """predictions ⋈ ground truth on the business id (shuffle join; AQE
    switches to broadcast only when a side turns out small)."""
    return predictions.join(truth, id_cols, how)


def performance_by_version(joined: DataFrame, truth: str, score: str, version_col: str = "model_version",
                           threshold: float = 0.5) -> DataFrame:
    labelled = joined.where(F.col(truth).isNotNull())
    return evaluate_binary(labelled, truth, score, threshold, group_by=[version_col])


def feature_profile(df: DataFrame, columns) -> DataFrame:
    """(column_name, n_rows, null_rate, min, max, mean, n_distinct) for columns
    of any atomic type.

    Cells are unpivoted and counted per (column, value), so distinct counts
    need no copy of the rows per column.  Minimum, maximum and mean are those
    of the numbers (booleans 0 / 1, timestamps as epoch seconds) and NULL for
    text; distinct values are compared in their own type."""
    types = dict(df.dtypes)

    def number(c: str):
        t = types[c]
        if t.startswith(("timestamp", "date")):
            return F.unix_seconds(F.col(c).cast("timestamp")).cast("double")
        return F.lit(None).cast("double") if t in ("string", "binary") else F.col(c).cast("double")

    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"), number(c).alias("x")) for c in columns])
    counts = df.select(F.explode(cells).alias("_e")).select("_e.*").groupBy("column_name", "v").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("x"))
    there = F.col("v").isNotNull()
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"), F.try_divide(F.sum(F.when(there, 0).otherwise(F.col("n"))), F.sum("n")).alias("null_rate"),
        F.min("x").alias("min_value"), F.max("x").alias("max_value"),
        F.try_divide(F.sum(F.col("x") * F.col("n")), F.sum(F.when(F.col("x").isNotNull(), F.col("n")))).alias("mean_value"),
        F.count(F.when(there, 1)).alias("n_distinct"))


def psi(df: DataFrame, value: str, period_col: str, baseline: str, current: str,
        edges: list[float]) -> DataFrame:
    """Population stability index over fixed bins (our choice of drift
    statistic): Σ (q − p)·ln(q / p) with shares floored at ``PSI_EPS``.
    Bin i holds ``edges[i] <= v < edges[i+1]``; values outside fall in the
    first / last bin; NULLs are their own bin."""
    inner = edges[1:-1]
    b = F.when(F.col(value).isNull(), F.lit(-1))
    idx = F.lit(0)
    for e in inner:
        idx = idx + (F.col(value) >= F.lit(float(e))).cast("int")
    b = b.otherwise(idx)
    counts = (df.where(F.col(period_col).isin(baseline, current))
                .groupBy(b.alias("bin")).agg(
                    F.sum((F.col(period_col) == baseline).cast("long")).alias("n_base"),
                    F.sum((F.col(period_col) == current).cast("long")).alias("n_cur")))
    # counts: one row per bin (bounded by ``edges``), so period totals are a
    # window over that small table
    whole = Window.partitionBy()
    shares = counts.select(
        "bin", F.greatest(F.try_divide(F.col("n_base"), F.sum("n_base").over(whole)), F.lit(PSI_EPS)).alias("p"),
        F.greatest(F.try_divide(F.col("n_cur"), F.sum("n_cur").over(whole)), F.lit(PSI_EPS)).alias("q"))
    return shares.agg(F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("psi")) \
                 .select(F.lit(value).alias("column_name"), "psi",
                         (F.col("psi") > F.lit(DRIFT_THRESHOLD)).alias("drift"))


def retrain_trigger(new_label_count: DataFrame, drift: DataFrame | None = None,
                    performance: DataFrame | None = None, metric: str = "roc_auc",
                    min_new_labels: int = MIN_NEW_LABELS) -> DataFrame:
    """One row of booleans; ``retrain`` = enough new labels, or drift, or
    performance under the floor (each only when its input is given)."""
    out = new_label_count.select(F.col("n_new_labels"),
                                 (F.col("n_new_labels") >= F.lit(min_new_labels)).alias("enough_new_labels"))
    reasons = [F.col("enough_new_labels")]
    if drift is not None:
        out = attach_row(out, drift.agg(F.max("psi").alias("max_psi")))
        out = out.withColumn("drift_detected", F.coalesce(F.col("max_psi") > F.lit(DRIFT_THRESHOLD), F.lit(False)))
        reasons.append(F.col("drift_detected"))
    if performance is not None:
        out = attach_row(out, performance.agg(F.min(metric).alias("perf")))
        out = out.withColumn("below_floor", F.coalesce(F.col("perf") < F.lit(PERFORMANCE_FLOOR), F.lit(False)))
        reasons.append(F.col("below_floor"))
    r = reasons[0]
    for x in reasons[1:]:
        r = r | x
    return out.withColumn("retrain", r)


def feature_lookup(requests: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    """Request keys ⋈ latest feature row per key (left join: unknown keys
    keep NULL features).  Neither side is assumed small."""
    return requests.join(latest, key, "left")
