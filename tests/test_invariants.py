"""SURVEY §5.2 invariants: no look-ahead, pinned snapshot digests, edge keys."""

from pyspark.sql import functions as F

from helpers import assert_same
from quarry.functions.digest import dataset_digest
from quarry.operators import monitor as mon
from quarry.operators import windows as W
from quarry.plans import queries as Q
from quarry.sources import tables as tb
from quarry.sources.snapshots import SnapshotTable

from conftest import SF_MID

CUT = "2024-01-12 00:00:00"


def _features(df):
    f = W.sequence_features(df.withColumn("k", tb.per_row_k()), Q.EV, "value", k_col="k")
    c = W.interval_stats(df, Q.EV, "value", {"n24": ("count", 86400), "s24": ("sum", 86400), "x7": ("max", 7 * 86400)})
    cols = ["exp_mean", "exp_std", "exp_max", "last_k_sum", "minutes_since_prev"]
    return f.select("event_id", "exp_count", *[Q.r6(x).alias(x) for x in cols]).join(
        c.select("event_id", "n24", Q.r6("s24").alias("s24"), "x7"), "event_id")


def test_no_feature_reads_later_rows(spark):
    ev = tb.transactions(spark, SF_MID)
    early = ev.where(F.col("ts") <= F.lit(CUT).cast("timestamp_ntz"))
    full = _features(ev).join(early.select("event_id"), "event_id")
    assert_same(_features(early).toPandas(), full.toPandas())


def test_pinned_snapshot_digest_reproducible(spark, tmp_dir):
    t = SnapshotTable(spark, tmp_dir + "/s")
    t.publish(tb.transactions(spark, SF_MID))
    t.publish(tb.transactions(spark, SF_MID).where(F.col("value") > 10))
    hist = {r["version"]: r["digest_sum"] for r in t.history().collect()}
    for v in (0, 1):
        again = dataset_digest(t.read(v)).first()["digest_sum"]
        assert again == hist[v]
    assert hist[0] != hist[1]


def test_one_event_key_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 7, "2024-01-01 00:00:00", 5.0), (2, 8, "2024-01-01 00:00:00", None), (3, 8, "2024-01-01 01:00:00", 4.0)],
        "event_id long, user_id long, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    f = {r["event_id"]: r for r in W.sequence_features(df, Q.EV, "value").collect()}
    assert f[1]["exp_std"] == 0.0 and f[1]["minutes_since_prev"] is None and f[1]["exp_count"] == 1
    assert f[2]["exp_mean"] is None and f[3]["exp_mean"] == 4.0 and f[3]["minutes_since_prev"] == 60.0
    s = {r["event_id"]: r for r in W.interval_stats(df, Q.EV, "value", {"m": ("mean", 7200), "n": ("count", 7200)}).collect()}
    assert s[2]["m"] is None and s[2]["n"] == 0 and s[3]["m"] == 4.0 and s[3]["n"] == 1


def test_profile_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    r = mon.feature_profile(df, ["x"]).first()
    assert r["null_rate"] == 1.0 and r["min_value"] is None and r["n_distinct"] == 0
