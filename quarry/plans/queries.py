"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each reads the driver tables (whole tables) through ``quarry.sources.tables``
and runs the library operators.  Derived doubles are rounded with ``r6``
(``round(x + 1e-9, 6)``, applied identically in the DuckDB oracle) so that
exact decimal midpoints do not round differently in the two engines.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.digest import dataset_digest, feature_set_digest_col, row_digest
from quarry.functions.scalar import hour_of_day, weekday_name
from quarry.functions.uris import model_uri
from quarry.operators import dataset as ds
from quarry.operators import metrics as mt
from quarry.operators import monitor as mon
from quarry.operators import prep
from quarry.operators import registry as reg
from quarry.operators import split as sp
from quarry.operators import windows as W
from quarry.operators.asof import asof_join
from quarry.operators.asof_available import asof_available_join
from quarry.operators.drift import column_drift, fit_baseline
from quarry.operators.keyed import EventOrder
from quarry.operators.model import feature_entries, fit_model, importance_frame, preprocessing_stages
from quarry.operators.scoring import Provenance, score_rows
from quarry.operators.verify import verify_scored_rows
from quarry.plans.batch_scoring import ScoreConfig
from quarry.plans.batch_scoring import score as score_job
from quarry.plans.training import model_path
from quarry.session import scratch_path
from quarry.sources import snapshots as snap
from quarry.sources import tables as tb
from quarry.sources.ingest import clean, delayed_labels
from quarry.spec import FeatureSpec

EV = EventOrder("user_id", "ts", "event_id")
ORD = EventOrder("o_custkey", "o_orderdate", "o_orderkey")
DOC_SPEC = FeatureSpec(metadata=("doc_id",), numeric=("n_chars",), categorical=("lang", "source"),
                       target="label")
SEED = 42
VAL_FRACTION, TEST_FRACTION = 0.2, 0.1
CUTOFF = "2024-01-15 00:00:00"
TRUTH_CUTOFF = "2024-01-25 00:00:00"
DRIFT_SPLIT = "2024-01-16 00:00:00"
PSI_EDGES = [float(x) for x in range(0, 550, 50)]
#: The learner's features: those of DOC_SPEC and a boolean with NULLs.
LEARN_SPEC = FeatureSpec(metadata=("doc_id",), numeric=("n_chars",), boolean=("long_text",), categorical=("lang", "source"), target="label")


def r6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1e-9), 6)


def r2(c: Column | str) -> Column:
    """Amounts of large magnitude: two decimals, on both engines."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1e-5), 2)


# ---------------------------------------------------------------- features

def _seq(spark, d, **kw):
    ev = tb.transactions_with_positions(spark, d).withColumn("k", tb.per_row_k())
    return W.sequence_features(ev, EV, "value", k_col="k", lat="lat", lon="lon", **kw)


def feat_expanding(spark: SparkSession, d: str) -> DataFrame:
    f = W.sequence_features(tb.transactions(spark, d), EV, "value")
    return f.select("event_id", "user_id", "exp_count", r6("exp_mean").alias("exp_mean"),
                    r6("exp_std").alias("exp_std"), r6("exp_max").alias("exp_max"))


def feat_ratio(spark, d):
    f = W.sequence_features(tb.transactions(spark, d), EV, "value")
    return f.select("event_id", r6("value_ratio").alias("value_ratio"))


def feat_outlier_flag(spark, d):
    f = W.sequence_features(tb.transactions(spark, d), EV, "value")
    return f.select("event_id", "above_2x_mean")


def feat_last_k_sum(spark, d):
    ev = tb.transactions(spark, d).withColumn("k", tb.per_row_k())
    f = W.sequence_features(ev, EV, "value", k_col="k")
    return f.select("event_id", "k", r6("last_k_sum").alias("last_k_sum"))


def feat_recency(spark, d):
    f = W.sequence_features(tb.transactions(spark, d), EV, "value")
    return f.select("event_id", r6("minutes_since_prev").alias("minutes_since_prev"))


def feat_distance(spark, d):
    f = W.sequence_features(tb.transactions_with_positions(spark, d), EV, "value", lat="lat", lon="lon")
    return f.select("event_id", r6("dist_prev_km").alias("dist_prev_km"))


def feat_prior_count(spark, d):
    f = W.sequence_features(tb.transactions(spark, d), EV, "value")
    return f.select("event_id", "prior_count")


def feat_all(spark, d):
    """All row-ordered features in one window pass (one Exchange)."""
    f = _seq(spark, d)
    return f.select("event_id", "user_id", "exp_count", "prior_count",
                    *[r6(c).alias(c) for c in ("exp_mean", "exp_std", "exp_max", "value_ratio",
                                               "minutes_since_prev", "dist_prev_km", "last_k_sum")],
                    "above_2x_mean")


def feat_window_counts(spark, d):
    f = W.interval_counts(tb.transactions(spark, d), EV, {"cnt_1h": 3600, "cnt_24h": 86400, "cnt_7d": 7 * 86400})
    return f.select("event_id", "cnt_1h", "cnt_24h", "cnt_7d")


def feat_window_values(spark, d):
    ev = tb.transactions(spark, d)
    f = W.interval_stats(ev, EV, "value", {
        "sum_24h": ("sum", 86400), "mean_30d": ("mean", 30 * 86400), "std_30d": ("std", 30 * 86400),
        "max_30d": ("max", 30 * 86400)})
    return f.select(
        "event_id", *[r6(c).alias(c) for c in ("sum_24h", "mean_30d", "std_30d", "max_30d")])


def feat_order_window_values(spark, d):
    """Moving frames over tied times with a level shift and absurd values, hot keys cut into small pieces.

    Frames that hold an absurd value are reported as such and not compared."""
    f = W.interval_stats(tb.shifted_orders(spark, d), ORD, "amount", {
        "sum_90d": ("sum", 90 * 86400), "mean_365d": ("mean", 365 * 86400), "std_365d": ("std", 365 * 86400),
        "max_90d": ("max", 90 * 86400), "max_365d": ("max", 365 * 86400), "n_90d": ("count", 90 * 86400)}, hot_threshold=4)
    sane_90, sane_365 = F.col("max_90d") < tb.ABSURD, F.col("max_365d") < tb.ABSURD
    return f.select("o_orderkey", "n_90d", sane_90.alias("sane_90d"), sane_365.alias("sane_365d"),
                    F.when(sane_90, r2("sum_90d")).alias("sum_90d"), F.when(sane_365, r2("mean_365d")).alias("mean_365d"),
                    F.when(sane_365, r2("std_365d")).alias("std_365d"))


def feat_last_k_orders(spark, d):
    """Last-k sums over tied times with k from 1 to beyond every key's rows."""
    orders = tb.order_stream(spark, d).withColumn("k", tb.wide_k())
    f = W.sequence_features(orders, ORD, "o_totalprice", k_col="k", hot_threshold=12)
    return f.select("o_orderkey", "k", r2("last_k_sum").alias("last_k_sum"))


def feat_p95_flag(spark, d):
    f = W.prior_quantile_flag(tb.transactions(spark, d), EV, "value", 0.95)
    return f.select("event_id", r6("prior_p95").alias("prior_p95"), "above_prior_p95")


def calendar_features(spark, d):
    ev = tb.transactions(spark, d)
    return ev.select("event_id", hour_of_day("ts").alias("hour"), weekday_name("ts").alias("weekday"))


def online_latest(spark, d):
    f = W.sequence_features(tb.transactions(spark, d), EV, "value")
    latest = W.latest_per_key(f, EV, ["event_id", "ts", "exp_count", "exp_mean"])
    return latest.select("user_id", "event_id", "ts", "exp_count", r6("exp_mean").alias("exp_mean"))


def feature_snapshot_asof(spark, d):
    ev = tb.transactions(spark, d).where(F.col("ts") <= F.lit(CUTOFF).cast("timestamp_ntz"))
    f = W.sequence_features(ev, EV, "value")
    latest = W.latest_per_key(f, EV, ["event_id", "ts", "exp_count", "exp_mean"])
    return latest.select("user_id", "event_id", "ts", "exp_count", r6("exp_mean").alias("exp_mean"))


def feature_lookup(spark, d):
    orders = tb.order_stream(spark, d)
    f = W.sequence_features(orders, ORD, "o_totalprice", prefix="f_")
    latest = W.latest_per_key(f, ORD, ["o_orderkey", "o_orderdate", "f_exp_count", "f_exp_mean"])
    req = tb.read_table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    j = mon.feature_lookup(req, latest, "o_custkey")
    return j.select("o_custkey", "o_orderkey", "o_orderdate", F.col("f_exp_count").alias("exp_count"),
                    r6("f_exp_mean").alias("exp_mean"))


# ---------------------------------------------------------------- joins

def _order_labels(spark, d) -> DataFrame:
    o = tb.order_stream(spark, d)
    return delayed_labels(o, "o_orderkey", "o_custkey", "o_orderdate",
                          F.col("o_orderstatus") == "F", F.lit(2) + F.col("o_orderkey") % 5)


def delayed_label_table(spark, d):
    return _order_labels(spark, d).select("o_orderkey", "o_custkey", "event_ts", "label_ts", "label")


def asof_label_join(spark, d):
    left = tb.order_stream(spark, d).select("o_orderkey", "o_custkey", "o_orderdate")
    labels = _order_labels(spark, d).select(F.col("o_orderkey").alias("label_order"), "o_custkey",
                                            "label_ts", "label")
    j = asof_join(left, labels, left_key="o_custkey", right_key="o_custkey", left_time="o_orderdate",
                  right_time="label_ts", right_tie="label_order", payload=["label_order", "label_ts", "label"],
                  prefix="l_")
    return j


def asof_available_labels(spark, d):
    """The label of the customer's latest order up to each order that was available by the order's own cutoff.

    NULLs on both axes of both sides; hot keys are ranked and swept in small chunks."""
    left = tb.order_stream(spark, d).select("o_orderkey", "o_custkey", tb.gappy("o_orderdate", 13).alias("as_of"),
                                            tb.label_cutoff().alias("cutoff"))
    slow = delayed_labels(tb.order_stream(spark, d), "o_orderkey", "o_custkey", "o_orderdate",
                          F.col("o_orderstatus") == "F", F.col("o_orderkey") * 7 % 700)
    labels = slow.select(F.col("o_orderkey").alias("label_order"), "o_custkey", tb.gappy("event_ts", 17).alias("event_ts"),
                         tb.gappy("label_ts", 19).alias("available_ts"), "label")
    return asof_available_join(left, labels, left_key="o_custkey", right_key="o_custkey", left_time="as_of", left_cutoff="cutoff",
                               right_time="event_ts", right_available="available_ts", right_tie="label_order",
                               payload=["label_order", "available_ts", "label"], prefix="l_", hot_threshold=24)


def _predictions(spark, d) -> DataFrame:
    ev = tb.transactions(spark, d)
    return ev.select("event_id", "user_id", F.col("ts").alias("prediction_timestamp"),
                     (F.lit(1) + F.col("event_id") % 3).cast("string").alias("model_version"),
                     tb.deterministic_score().alias("score"))


def _truth(spark, d) -> DataFrame:
    ev = tb.transactions(spark, d)
    lab = delayed_labels(ev, "event_id", "user_id", "ts", tb.deterministic_truth().cast("int"),
                         F.lit(2) + F.col("event_id") % 5)
    return lab.where(F.col("label_ts") <= F.lit(TRUTH_CUTOFF).cast("timestamp_ntz")) \
              .select("event_id", F.col("label").alias("truth"))


def prediction_truth_join(spark, d):
    p = _predictions(spark, d)
    feats = tb.transactions(spark, d).select("event_id", "value")
    j = mon.join_truth(p.join(feats, "event_id"), _truth(spark, d), ["event_id"])
    return j.select("event_id", "model_version", "score", "value", "truth")


# ---------------------------------------------------------------- datasets

def _docs(spark, d) -> DataFrame:
    return tb.documents_with_labels(spark, d)


def labeled_rows(spark, d):
    return ds.labeled_rows(_docs(spark, d), DOC_SPEC)


def row_sample(spark, d):
    """Five input examples of each source and label state, the same whatever the partitioning."""
    docs = _docs(spark, d).withColumn("labelled", F.col("label").isNotNull())
    return ds.sample_rows(docs, "doc_id", 5, SEED, ("source", "labelled")).select("doc_id", "source", "labelled", "n_chars")


def unlabeled_rows(spark, d):
    return ds.unlabeled_rows(_docs(spark, d), DOC_SPEC)


def class_balance(spark, d):
    return ds.class_balance(ds.labeled_rows(_docs(spark, d), DOC_SPEC), "label")


def label_assign(spark, d):
    ev = tb.transactions(spark, d).select("event_id")
    return ds.assign_labels(ev, "event_id", seed=SEED, out="label")


def new_labels(spark, d):
    docs = _docs(spark, d).withColumn("_v", F.col("doc_id") % 3)
    cur = ds.labeled_rows(snap.read_append_log(docs, "_v", 2), DOC_SPEC)
    prev = ds.labeled_rows(snap.read_append_log(docs, "_v", 1), DOC_SPEC)
    return ds.new_labels(cur, prev, ["doc_id"]).select("doc_id", "label")


def _split(spark, d) -> DataFrame:
    lab = ds.labeled_rows(_docs(spark, d), DOC_SPEC)
    return sp.stratified_split(lab, "doc_id", "label", VAL_FRACTION, TEST_FRACTION, SEED)


def stratified_split(spark, d):
    return _split(spark, d).select("doc_id", "label", "split")


def stable_split(spark, d):
    lab = ds.labeled_rows(_docs(spark, d), DOC_SPEC)
    return sp.stable_split(lab, "doc_id", VAL_FRACTION, TEST_FRACTION, SEED).select("doc_id", "split")


def split_counts(spark, d):
    return sp.split_counts(_split(spark, d), "label")


def split_manifest(spark, d):
    s = _split(spark, d)
    return dataset_digest(s, list(DOC_SPEC.training_columns), group_by=["split"]) \
        .select("split", "n_rows", "digest_sum")


# ---------------------------------------------------------------- metrics

def _scored(spark, d) -> DataFrame:
    return tb.scored_events(spark, d)


def threshold_metrics(spark, d):
    m = mt.threshold_metrics(_scored(spark, d), "truth", "score", 0.5)
    return m.select("tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


def average_precision(spark, d):
    return mt.ranking_metrics(_scored(spark, d), "truth", "score").select(
        r6("average_precision").alias("average_precision"))


def roc_auc(spark, d):
    return mt.ranking_metrics(_scored(spark, d), "truth", "score").select(r6("roc_auc").alias("roc_auc"))


def logloss_accuracy(spark, d):
    m = mt.logloss_accuracy(_scored(spark, d), "truth", "score", 0.5)
    return m.select(r6("accuracy").alias("accuracy"), r6("log_loss").alias("log_loss"))


def evaluate_model(spark, d):
    m = mt.evaluate_binary(_scored(spark, d), "truth", "score", 0.5)
    return m.select(*[r6(c).alias(c) for c in ("average_precision", "f1", "precision", "recall", "roc_auc")])


def _two_models(spark, d) -> DataFrame:
    """Champion and challenger scores over the same rows (as columns)."""
    ev = tb.transactions(spark, d)
    return ev.select("event_id", "user_id", tb.deterministic_truth().cast("int").alias("truth"),
                     tb.deterministic_score("value", 40.0, 30.0).alias("s_champion"),
                     tb.deterministic_score("value", 45.0, 25.0).alias("s_challenger"))


def _role_metrics(two: DataFrame, group_by=()) -> DataFrame:
    """Metrics of both roles in one pass: the role is one more group."""
    roles = F.array(*[F.struct(F.lit(r).alias("role"), F.col(f"s_{r}").alias("score")) for r in (reg.CHAMPION, reg.CHALLENGER)])
    long = two.select(*group_by, "truth", F.explode(roles).alias("_r")).select(*group_by, "truth", "_r.role", "_r.score")
    return mt.evaluate_binary(long, "truth", "score", 0.5, group_by=[*group_by, "role"])


def champion_challenger_eval(spark, d):
    dec = reg.compare_scores(_role_metrics(_two_models(spark, d)), reg.PRIMARY_METRIC)
    return dec.select("metric_name", r6("challenger_score").alias("challenger_score"),
                      r6("champion_score").alias("champion_score"), "promoted")


def promotion_gate(spark, d):
    two = _two_models(spark, d)
    ch = mt.logloss_accuracy(two.select("truth", F.col("s_challenger").alias("score")), "truth", "score")
    cp = mt.logloss_accuracy(two.select("truth", F.col("s_champion").alias("score")), "truth", "score")
    g = reg.promotion_gate(ch, cp)
    return g.select(r6("accuracy_gain").alias("accuracy_gain"), r6("log_loss_increase").alias("log_loss_increase"),
                    "accuracy_ok", "log_loss_ok", "promote")


# ---------------------------------------------------------------- registry tables

def _alias_events(spark, d) -> DataFrame:
    ev = tb.transactions(spark, d)
    return ev.select(F.concat(F.lit("model_"), (F.col("user_id") % 4).cast("string")).alias("model_name"),
                     F.when(F.col("event_type").isin("purchase", "click"), F.lit(reg.CHAMPION))
                      .otherwise(F.lit(reg.CHALLENGER)).alias("alias"),
                     (F.lit(1) + F.col("event_id") % 9).cast("string").alias("version"),
                     F.col("ts").cast("timestamp").alias("event_ts"), F.col("event_id").alias("seq"))


def alias_current(spark, d):
    return reg.current_aliases(_alias_events(spark, d))


def tags_current(spark, d):
    ev = tb.read_table(spark, d, "events")
    tags = ev.select(F.concat(F.lit("model_"), (F.col("user_id") % 4).cast("string")).alias("model_name"),
                     (F.lit(1) + F.col("event_id") % 9).cast("string").alias("version"),
                     F.col("event_type").alias("key"), F.col("props").alias("value"),
                     F.col("ts").cast("timestamp").alias("event_ts"), F.col("event_id").alias("seq"))
    return reg.current_tags(tags)


def registry_version_for_run(spark, d):
    ev = tb.transactions(spark, d)
    mv = ev.select(F.concat(F.lit("model_"), (F.col("user_id") % 4).cast("string")).alias("model_name"),
                   F.col("event_id").cast("string").alias("version"),
                   F.concat(F.lit("run_"), (F.col("event_id") % 50).cast("string")).alias("run_id"))
    return reg.version_for_run(mv)


def promotion_decision(spark, d):
    """Per model: current champion/challenger aliases, AP of both scorers on
    the model's rows, decision (strict >) and the resulting champion."""
    two = _two_models(spark, d).withColumn(
        "model_name", F.concat(F.lit("model_"), (F.col("user_id") % 4).cast("string")))
    m = _role_metrics(two, ["model_name"])
    ch = m.where(F.col("role") == reg.CHALLENGER).select("model_name", F.col(reg.PRIMARY_METRIC).alias("challenger_score"))
    cp = m.where(F.col("role") == reg.CHAMPION).select("model_name", F.col(reg.PRIMARY_METRIC).alias("champion_score"))
    al = reg.current_aliases(_alias_events(spark, d))
    champ = al.where(F.col("alias") == reg.CHAMPION).select("model_name", F.col("version").alias("champion_version"))
    chall = al.where(F.col("alias") == reg.CHALLENGER).select("model_name", F.col("version").alias("challenger_version"))
    j = ch.join(cp, "model_name", "left").join(champ, "model_name", "left").join(chall, "model_name", "left")
    promoted = reg.promoted(F.col("challenger_score"), F.col("champion_score"))
    return j.select("model_name", "champion_version", "challenger_version",
                    r6("challenger_score").alias("challenger_score"), r6("champion_score").alias("champion_score"),
                    promoted.alias("promoted"),
                    F.when(promoted, F.col("challenger_version")).otherwise(F.col("champion_version"))
                     .alias("new_champion_version"))


def _model_versions(spark, d) -> DataFrame:
    """Registered versions: each one's run, and the feature snapshot that the run read."""
    ev = tb.transactions(spark, d).where(F.col("event_id") % 3 < 2)
    return ev.groupBy(F.concat(F.lit("model_"), (F.col("user_id") % 4).cast("string")).alias("model_name"),
                      (F.lit(1) + F.col("event_id") % 3).cast("string").alias("version")).agg(
        F.concat(F.lit("run_"), F.max("event_id").cast("string")).alias("run_id"), (F.max("event_id") % 4).alias("snapshot_version"))


def _promotion_log(spark, d) -> DataFrame:
    ev = tb.transactions(spark, d)
    return ev.where(F.col("event_type") == "purchase").select(
        F.concat(F.lit("model_"), (F.col("user_id") % 4).cast("string")).alias("model_name"),
        (F.lit(1) + F.col("event_id") % 3).cast("string").alias("challenger_version"),
        (F.col("value") > 40).alias("promoted"), F.col("ts").alias("decided_ts"))


def audit_trail(spark, d):
    """Predictions per model version, traced to the run that made it, the
    snapshot the run read, its last promotion and its aliases.  What the
    registry does not hold stays NULL."""
    p = _predictions(spark, d).withColumn("model_name", F.concat(F.lit("model_"), (F.col("user_id") % 4).cast("string")))
    per = p.groupBy("model_name", "model_version").agg(
        F.count(F.lit(1)).alias("n_predictions"), F.max("prediction_timestamp").alias("last_prediction_ts"))
    versions = _model_versions(spark, d).withColumnRenamed("version", "model_version")
    history = snap.append_log_history(_event_log(spark, d), "first_version", "ts").select(
        F.col("version").alias("snapshot_version"), F.col("n_rows").alias("snapshot_rows"))
    wins = (_promotion_log(spark, d).where("promoted").groupBy("model_name", F.col("challenger_version").alias("model_version"))
            .agg(F.max("decided_ts").alias("promoted_ts")))
    aliases = (reg.current_aliases(_alias_events(spark, d)).groupBy("model_name", "version")
                 .agg(F.array_join(F.array_sort(F.collect_set("alias")), ",").alias("aliases"))
                 .withColumnRenamed("version", "model_version"))
    keys = ["model_name", "model_version"]
    j = per.join(versions, keys, "left").join(history, "snapshot_version", "left").join(wins, keys, "left").join(aliases, keys, "left")
    return j.select("model_name", "model_version", model_uri(F.col("model_name"), version=F.col("model_version")).alias("model_uri"),
                    "run_id", "snapshot_version", "snapshot_rows", "promoted_ts",
                    "n_predictions", "last_prediction_ts", F.coalesce("aliases", F.lit("")).alias("aliases"))


# ---------------------------------------------------------------- preprocessing

def _events_with_nulls(spark, d) -> DataFrame:
    return tb.transactions(spark, d).withColumn("value_null", tb.nullable_value())


def impute_median(spark, d):
    ev = _events_with_nulls(spark, d)
    med = prep.fit_medians(ev, ["value_null"])
    out = prep.impute(ev, med)
    return out.select("event_id", r6("value_null").alias("value_imputed"))


def _learn_docs(spark, d) -> DataFrame:
    return _docs(spark, d).withColumn("long_text", F.when(F.col("doc_id") % 11 == 0, F.lit(None).cast("boolean")).otherwise(F.col("n_chars") > F.lit(1500)))


def _docs_with_nulls(spark, d) -> DataFrame:
    docs = tb.read_table(spark, d, "documents").select("doc_id", "n_chars", "lang", "source")
    return docs.withColumns({
        "lang_null": F.when(F.col("doc_id") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("lang")),
        "source_null": F.when(F.col("doc_id") % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("source")),
        "long_doc": F.when(F.col("doc_id") % 5 == 0, F.lit(None).cast("boolean"))
                     .otherwise(F.col("n_chars") > F.lit(5000)),
    })


def impute_mode(spark, d):
    docs = _docs_with_nulls(spark, d)
    modes = prep.fit_modes(docs, ["lang_null", "source_null"])
    out = prep.impute(docs, modes)
    return out.select("doc_id", F.col("lang_null").alias("lang_imputed"), F.col("source_null").alias("source_imputed"))


def category_vocab(spark, d):
    docs = tb.read_table(spark, d, "documents").select("lang", "source")
    return prep.vocabulary(docs, ["lang", "source"])


def order_codes(spark, d):
    """Codes of columns with as many values as rows, all with one beginning, fitted on four fifths of the
    orders and looked up for all."""
    orders = tb.order_stream(spark, d).select(
        "o_orderkey", F.concat(F.lit("merchant_"), F.col("o_orderkey")).alias("merchant"),
        F.concat(F.lit("merchant_"), tb.gappy("o_custkey", 13)).alias("customer"), "o_orderstatus")
    columns = ["merchant", "customer", "o_orderstatus"]
    vocab = prep.vocabulary(orders.where(F.col("o_orderkey") % 5 != 0), columns)
    return prep.encode_rows(orders, ["o_orderkey"], columns, vocab)


def one_hot(spark, d):
    """Fit and transform on different rows: mode-impute + StringIndexer(keep) +
    one-hot fitted on ``lang <> 'fr'`` and applied to every row, so that ``fr``
    is an unseen value; non-zero slots as rows."""
    docs = _docs_with_nulls(spark, d)
    spec = FeatureSpec(metadata=("doc_id",), categorical=("lang_null", "source_null"), boolean=("long_doc",))
    fit_rows = docs.where(F.col("lang") != "fr")
    stages = preprocessing_stages(spec)[:-1]  # without the assembler
    pm = Pipeline(stages=stages).fit(fit_rows)
    return feature_entries(pm, spec, pm.transform(docs), ["doc_id"]).select("doc_id", "column_name", "slot")


def feature_matrix(spark, d):
    """Assembled feature vectors (numeric, then one-hot slots) as long-form
    non-zero entries (doc_id, slot, value)."""
    spec = FeatureSpec(metadata=("doc_id",), numeric=("n_chars",), categorical=("lang", "source"))
    docs = tb.read_table(spark, d, "documents").select("doc_id", "n_chars", "lang", "source")
    pm = Pipeline(stages=preprocessing_stages(spec)[:-1]).fit(docs)
    return feature_entries(pm, spec, pm.transform(docs), ["doc_id"]).select("doc_id", F.col("position").alias("slot"), "value")


# ---------------------------------------------------------------- model + scoring

def _fitted(spark, d):
    return fit_model(ds.labeled_rows(_learn_docs(spark, d), LEARN_SPEC), LEARN_SPEC)


def gbt_train_score(spark, d):
    model = _fitted(spark, d)
    unl = ds.unlabeled_rows(_learn_docs(spark, d), LEARN_SPEC)
    return model.predict_proba(unl, "score").select("doc_id", "score")


def learner_quality(spark, d):
    """What must hold of the fitted learner, whatever its scores: trees, encoded features, shares of importance, log-loss below the prior's."""
    model = _fitted(spark, d)
    scored = model.predict_proba(ds.labeled_rows(_learn_docs(spark, d), LEARN_SPEC), "p")
    y, share = F.col("label"), F.col("share")
    loss = lambda p: F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p)))
    row = mt.attach_row(scored, scored.agg(F.avg("label").alias("share"))).agg(
        F.count(F.lit(1)).alias("n_rows"), (loss(F.col("p")) < loss(share)).alias("beats_prior"), F.min(F.col("p").between(0, 1)).alias("probabilities"))
    importance = [v for _, v in model.feature_importance()]
    return row.select("n_rows", "beats_prior", "probabilities", F.lit(len(model.pipeline.stages[-1].parts()[2])).cast("long").alias("n_trees"),
                      F.lit(len(importance)).cast("long").alias("n_features"), F.lit(round(sum(importance), 9)).alias("importance_total"))


def importance_topk(spark, d):
    return importance_frame(_fitted(spark, d), spark, top_k=10)


def _doc_score(df: DataFrame) -> DataFrame:
    z = -(F.log(F.col("n_chars").cast("double")) - F.lit(7.3))
    return df.withColumn("score", F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(z)), 3))


BATCH_PROVENANCE = Provenance(model_name="doc_quality", model_alias="champion", model_version="3",
                              model_source_run_id="run_3", feature_table="documents",
                              feature_table_version=2, feature_table_timestamp="2024-01-31T00:00:00",
                              prediction_timestamp="2024-02-01 00:00:00")


def batch_score(spark, d):
    unl = ds.unlabeled_rows(_docs(spark, d), DOC_SPEC)
    return score_rows(unl, DOC_SPEC, _doc_score, BATCH_PROVENANCE, threshold=0.5)


def verify_scored(spark, d):
    """Scored rows checked against the version that they name, after a second version changed some rows and
    lost others; some predictions name it wrongly, some another feature set or no version."""
    docs = ds.unlabeled_rows(_docs(spark, d), DOC_SPEC)
    table = snap.SnapshotTable(spark, scratch_path(spark, f"verify-{uuid.uuid4().hex}"))
    table.publish(docs, digest=False)
    part = F.col("doc_id") % 10
    table.publish(docs.where(part != 7).withColumn("n_chars", F.col("n_chars") + F.when(part == 3, 1).otherwise(0)), digest=False)
    scored = score_rows(table.read(0), DOC_SPEC, _doc_score, BATCH_PROVENANCE).withColumns({
        "feature_table_version": F.when(part < 2, "0").when(part < 8, "1").when(part == 8, "5"),
        "feature_set_digest": F.when(part == 1, "other").otherwise(F.col("feature_set_digest"))})
    return verify_scored_rows(scored, table, DOC_SPEC).select("doc_id", "feature_table_version", "verdict")


def scoring_job(spark, d):
    """The whole job: published snapshot, registered and aliased model fitted on
    its labelled rows, unlabelled rows scored into the sink, and read back."""
    root = scratch_path(spark, f"scoring-{uuid.uuid4().hex}")
    table = snap.SnapshotTable(spark, f"{root}/documents")
    table.publish(_docs(spark, d), digest=False)
    registry = reg.Registry(spark, f"{root}/registry")
    version = registry.register_version("doc_quality", "run_1")
    fit_model(ds.labeled_rows(table.read(), DOC_SPEC), DOC_SPEC).save(
        model_path(registry.root, "doc_quality", version))
    registry.set_alias("doc_quality", reg.CHAMPION, version)
    cfg = ScoreConfig(table.root, registry.root, f"{root}/predictions", "doc_quality", feature_table_name="documents")
    done = score_job(spark, DOC_SPEC, cfg)
    out = spark.read.parquet(cfg.output_path)
    p = F.col("fraud_probability")
    return out.select("doc_id", "model_name", "model_alias", "model_version", "model_source_run_id", "feature_table",
                      "feature_table_version", "feature_set_digest", "feature_vector_digest",
                      p.between(0, 1).alias("is_probability"), (F.col("predicted_label") == (p >= 0.5)).alias("label_follows"),
                      (F.col("predicted_class") == F.when(p >= 0.5, "fraud").otherwise("not_fraud")).alias("class_follows"),
                      F.lit(done["rows_written"]).cast("long").alias("rows_written"))


# ---------------------------------------------------------------- audit

ROW_DIGEST_COLS = ["event_id", "user_id", "event_type", "value", "k"]


def row_digest_q(spark, d):
    ev = tb.transactions(spark, d).withColumn("k", tb.per_row_k())
    return ev.select("event_id", row_digest(ev, ROW_DIGEST_COLS, {"value": (18, 2)}).alias("row_digest"))


def dataset_digest_q(spark, d):
    ev = tb.transactions(spark, d).withColumn("k", tb.per_row_k())
    return dataset_digest(ev, ROW_DIGEST_COLS, {"value": (18, 2)}, group_by=["event_type"]) \
        .select("event_type", "n_rows", "digest_sum", "columns_digest")


def feature_set_digest_q(spark, d):
    """Digest of the table's own columns, in the order of its schema."""
    ev = tb.read_table(spark, d, "events")
    return ev.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", feature_set_digest_col(ev.columns).alias("feature_set_digest"))


def _event_log(spark, d) -> DataFrame:
    return tb.transactions(spark, d).withColumn("first_version", F.col("event_id") % 3)


def snapshot_resolve(spark, d):
    h = snap.append_log_history(_event_log(spark, d), "first_version", "ts")
    return snap.resolve_version_frame(h)


def snapshot_read(spark, d):
    """Two versions with different schemas are published to the shared folder;
    the older one is read back as it was."""
    table = snap.SnapshotTable(spark, scratch_path(spark, f"events-{uuid.uuid4().hex}"))
    log = _event_log(spark, d)
    table.publish(snap.read_append_log(log, "first_version", 1).select("event_id", "user_id", "value"), digest=False)
    table.publish(log.select("event_id", "event_type"), digest=False)
    return table.read(0)


def _ingest_rule():
    return (F.col("value") > 0) & F.col("k").between(0, 89)


def clean_ingest(spark, d):
    raw = tb.read_table(spark, d, "events").select(
        F.col("event_id").alias("EventId"), F.col("user_id").alias("UserId"), F.col("event_type").alias("Event Type"),
        F.col("value").cast("string").alias("Value"),
        F.regexp_extract("props", r'"k":\s*(-?\d+)', 1).alias("K"))
    good, _ = clean(raw, {"value": "double", "k": "int"}, valid=_ingest_rule())
    return good


def clean_quarantine(spark, d):
    raw = tb.read_table(spark, d, "events").select(
        F.col("event_id").alias("EventId"), F.col("value").cast("string").alias("Value"),
        F.regexp_extract("props", r'"k":\s*(-?\d+)', 1).alias("K"))
    _, bad = clean(raw, {"value": "double", "k": "int"}, valid=_ingest_rule())
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- monitoring

def prediction_monitor(spark, d):
    m = mon.prediction_monitor(_predictions(spark, d))
    return m.select("model_version", "n_predictions", r6("mean_score").alias("mean_score"), "last_prediction_ts")


def monitor_performance(spark, d):
    j = mon.join_truth(_predictions(spark, d), _truth(spark, d), ["event_id"])
    m = mon.performance_by_version(j, "truth", "score")
    return m.select("model_version", *[r6(c).alias(c) for c in ("average_precision", "f1", "precision",
                                                                   "recall", "roc_auc")])


def feature_profile(spark, d):
    ev = _events_with_nulls(spark, d)
    p = mon.feature_profile(ev, ["value", "value_null", "user_id"])
    return p.select("column_name", "n_rows", r6("null_rate").alias("null_rate"), r6("min_value").alias("min_value"),
                    r6("max_value").alias("max_value"), r6("mean_value").alias("mean_value"), "n_distinct")


def _drift(spark, d) -> DataFrame:
    ev = tb.transactions(spark, d).withColumn(
        "period", F.when(F.col("ts") < F.lit(DRIFT_SPLIT).cast("timestamp_ntz"), F.lit("baseline"))
                   .otherwise(F.lit("current")))
    return mon.psi(ev, "value", "period", "baseline", "current", PSI_EDGES)


def feature_drift_psi(spark, d):
    return _drift(spark, d).select("column_name", r6("psi").alias("psi"), "drift")


def drift_by_column(spark, d):
    """Numeric, text and high-cardinality columns of later events against a baseline fitted on earlier ones
    and kept as a snapshot."""
    ev = tb.transactions(spark, d).select("ts", "value", tb.nullable_value().alias("value_null"), "event_type",
                                          F.col("user_id").cast("string").alias("user"))
    early = F.col("ts") < F.lit(DRIFT_SPLIT).cast("timestamp_ntz")
    later = ev.where(~early).withColumns({"value": F.col("value") * 1.5, "event_type": F.when(F.col("event_type") != "error", F.col("event_type"))})
    table = snap.SnapshotTable(spark, scratch_path(spark, f"baseline-{uuid.uuid4().hex}"))
    table.publish(fit_baseline(ev.where(early), ["value", "value_null"], ["event_type", "user"]), digest=False)
    return column_drift(table.read(), later).select("column_name", "n_base", "n_cur", r6("psi").alias("psi"), "drift")


def retrain_trigger(spark, d):
    n = new_labels(spark, d).agg(F.count(F.lit(1)).alias("n_new_labels"))
    t = mon.retrain_trigger(n, drift=_drift(spark, d))
    return t.select("n_new_labels", "enough_new_labels", "drift_detected", "retrain")


def retrain_by_labels(spark, d):
    """The default rule: the number of new labels alone."""
    n = new_labels(spark, d).agg(F.count(F.lit(1)).alias("n_new_labels"))
    return mon.retrain_trigger(n).select("n_new_labels", "enough_new_labels", "retrain")


QUERIES = {
    "feat_expanding": feat_expanding,
    "feat_ratio": feat_ratio,
    "feat_outlier_flag": feat_outlier_flag,
    "feat_last_k_sum": feat_last_k_sum,
    "feat_recency": feat_recency,
    "feat_distance": feat_distance,
    "feat_prior_count": feat_prior_count,
    "feat_all": feat_all,
    "feat_window_counts": feat_window_counts,
    "feat_window_values": feat_window_values,
    "feat_order_window_values": feat_order_window_values,
    "feat_last_k_orders": feat_last_k_orders,
    "feat_p95_flag": feat_p95_flag,
    "calendar_features": calendar_features,
    "online_latest": online_latest,
    "feature_snapshot_asof": feature_snapshot_asof,
    "feature_lookup": feature_lookup,
    "delayed_labels": delayed_label_table,
    "asof_label_join": asof_label_join,
    "asof_available_labels": asof_available_labels,
    "prediction_truth_join": prediction_truth_join,
    "labeled_rows": labeled_rows,
    "unlabeled_rows": unlabeled_rows,
    "row_sample": row_sample,
    "class_balance": class_balance,
    "label_assign": label_assign,
    "new_labels": new_labels,
    "stratified_split": stratified_split,
    "stable_split": stable_split,
    "split_counts": split_counts,
    "split_manifest": split_manifest,
    "threshold_metrics": threshold_metrics,
    "average_precision": average_precision,
    "roc_auc": roc_auc,
    "logloss_accuracy": logloss_accuracy,
    "evaluate_model": evaluate_model,
    "champion_challenger_eval": champion_challenger_eval,
    "promotion_gate": promotion_gate,
    "alias_current": alias_current,
    "tags_current": tags_current,
    "registry_version_for_run": registry_version_for_run,
    "promotion_decision": promotion_decision,
    "audit_trail": audit_trail,
    "impute_median": impute_median,
    "impute_mode": impute_mode,
    "category_vocab": category_vocab,
    "order_codes": order_codes,
    "one_hot": one_hot,
    "feature_matrix": feature_matrix,
    "gbt_train_score": gbt_train_score,
    "importance_topk": importance_topk,
    "learner_quality": learner_quality,
    "batch_score": batch_score,
    "verify_scored": verify_scored,
    "scoring_job": scoring_job,
    "row_digest": row_digest_q,
    "dataset_digest": dataset_digest_q,
    "feature_set_digest": feature_set_digest_q,
    "snapshot_resolve": snapshot_resolve,
    "snapshot_read": snapshot_read,
    "clean_ingest": clean_ingest,
    "clean_quarantine": clean_quarantine,
    "prediction_monitor": prediction_monitor,
    "monitor_performance": monitor_performance,
    "feature_profile": feature_profile,
    "feature_drift_psi": feature_drift_psi,
    "drift_by_column": drift_by_column,
    "retrain_trigger": retrain_trigger,
    "retrain_by_labels": retrain_by_labels,
}
