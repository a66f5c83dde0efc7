"""Binary-classification metrics as distributed aggregates.

* thresholded counts → precision, recall, F1 with ``zero_division = 0``;
* average precision  Σ (Rₙ − Rₙ₋₁)·Pₙ over distinct scores, descending
  (step-wise, not the trapezoid of ``areaUnderPR``);
* ROC AUC with ties counted half, NULL when a class is missing;
* accuracy and clipped log-loss.

All metrics of a call come from one table of distinct scores with positives
and negatives (partial aggregation), so rows are scanned and scored once.
AP and AUC need running totals over scores in descending order: the scores
are cut into contiguous ranges (``keyed.by_ranges``), per-range
totals give each range's offset, and a window per range gives the local
running sum.  No step ranks all distinct scores in one task.  A NULL group is
a group like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.keyed import by_ranges, join_null_safe

EPS_LOGLOSS = 1e-15


def _div0(num: Column, den: Column) -> Column:
    return F.coalesce(num / F.when(den != 0, den), F.lit(0.0))


def confusion_counts(df: DataFrame, truth: str, score: str, threshold: float, group_by=()) -> DataFrame:
    pred = F.col(score) >= F.lit(threshold)
    y = F.col(truth) == 1
    agg = [F.sum((pred & y).cast("long")).alias("tp"),
           F.sum((pred & ~y).cast("long")).alias("fp"),
           F.sum((~pred & y).cast("long")).alias("fn"),
           F.sum((~pred & ~y).cast("long")).alias("tn")]
    g = df.groupBy(*group_by) if group_by else df
    return g.agg(*agg)


def threshold_metrics(df: DataFrame, truth: str, score: str, threshold: float = 0.5,
                      group_by=()) -> DataFrame:
    c = confusion_counts(df, truth, score, threshold, group_by)
    precision = _div0(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _div0(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = _div0(F.lit(2.0) * F.col("tp"), F.lit(2) * F.col("tp") + F.col("fp") + F.col("fn"))
    return c.select(*group_by, "tp", "fp", "fn", "tn", precision.alias("precision"),
                    recall.alias("recall"), f1.alias("f1"))


def score_table(df: DataFrame, truth: str, score: str, group_by=()) -> DataFrame:
    """(group…, score, pos, neg) — one row per distinct score."""
    y = F.col(truth).cast("long")
    return (df.groupBy(*group_by, score)
              .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame (a global aggregate) to every row of
    ``df``.  The one-row side is broadcast, so each row meets exactly one row:
    a column lookup, not a pair product."""
    return df.crossJoin(F.broadcast(one_row))


def running_totals(st: DataFrame, score: str, group_by=()) -> DataFrame:
    """Add ``cum_pos`` / ``cum_neg``: totals over scores >= this score, and
    ``above_pos``: positives with strictly greater score (same group)."""
    g = list(group_by)
    # higher range = higher score within a group
    bucketed = by_ranges(st, [*g, score], "scores").withColumnRenamed("_r", "_b")
    tot = bucketed.groupBy(*g, "_b").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    wo = Window.partitionBy(*g).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = tot.select(*g, "_b", F.coalesce(F.sum("_bp").over(wo), F.lit(0)).alias("_op"),
                         F.coalesce(F.sum("_bn").over(wo), F.lit(0)).alias("_on"))
    wl = (Window.partitionBy(*g, "_b").orderBy(F.desc(score))
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = bucketed.withColumns({"_lp": F.sum("pos").over(wl), "_ln": F.sum("neg").over(wl)})
    out = join_null_safe(local, offsets, [*g, "_b"], "inner")
    return out.select(*g, score, "pos", "neg",
                      (F.col("_op") + F.col("_lp")).alias("cum_pos"),
                      (F.col("_on") + F.col("_ln")).alias("cum_neg"),
                      (F.col("_op") + F.col("_lp") - F.col("pos")).alias("above_pos"))


def ranking_metrics(df: DataFrame, truth: str, score: str, group_by=()) -> DataFrame:
    """``average_precision`` and ``roc_auc`` (NULL if one class is absent)."""
    return evaluate_binary(df, truth, score, 0.5, group_by).select(*group_by, "average_precision", "roc_auc")


def logloss_accuracy(df: DataFrame, truth: str, score: str, threshold: float = 0.5,
                     group_by=()) -> DataFrame:
    p = F.least(F.greatest(F.col(score), F.lit(EPS_LOGLOSS)), F.lit(1.0 - EPS_LOGLOSS))
    y = F.col(truth).cast("double")
    ll = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    correct = ((F.col(score) >= F.lit(threshold)).cast("int") == F.col(truth).cast("int")).cast("double")
    g = df.groupBy(*group_by) if group_by else df
    return g.agg(F.avg(correct).alias("accuracy"), F.avg(ll).alias("log_loss"))


def evaluate_binary(df: DataFrame, truth: str, score: str, threshold: float = 0.5,
                    group_by=()) -> DataFrame:
    """average_precision, f1, precision, recall, roc_auc (+ counts), from one score table."""
    g = list(group_by)
    rt = running_totals(score_table(df, truth, score, g), score, g)
    above = F.col(score) >= F.lit(threshold)

    def total(cond: Column, side: str, name: str) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col(side))), F.lit(0)).alias(name)

    t = rt.groupBy(*g).agg(
        F.sum("pos").alias("_P"), F.sum("neg").alias("_N"),
        F.sum(F.col("pos") * F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))).alias("_ap_num"),
        F.sum(F.col("neg") * (F.col("above_pos") + F.col("pos") / F.lit(2.0))).alias("_auc_num"),
        total(above, "pos", "tp"), total(above, "neg", "fp"), total(~above, "pos", "fn"), total(~above, "neg", "tn"))
    ap = F.when(F.col("_P") > 0, F.col("_ap_num") / F.col("_P")).otherwise(F.lit(0.0))
    auc = F.when((F.col("_P") > 0) & (F.col("_N") > 0), F.col("_auc_num") / (F.col("_P") * F.col("_N")))
    precision = _div0(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _div0(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = _div0(F.lit(2.0) * F.col("tp"), F.lit(2) * F.col("tp") + F.col("fp") + F.col("fn"))
    return t.select(*g, ap.alias("average_precision"), f1.alias("f1"), precision.alias("precision"), recall.alias("recall"),
                    auc.alias("roc_auc"), "tp", "fp", "fn", "tn")
