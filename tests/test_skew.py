"""Hot-key chunked plans give the same rows as the single-partition-per-key plans."""

import numpy as np
from pyspark.sql import functions as F

from helpers import assert_same
from quarry.operators import windows as W
from quarry.operators.asof import asof_join
from quarry.operators.keyed import EventOrder, hot_key_chunks
from quarry.plans import queries as Q
from quarry.sources import tables as tb

from conftest import SF_MID

EV = EventOrder("user_id", "ts", "event_id")


def _seq(spark, th):
    ev = tb.transactions_with_positions(spark, SF_MID).withColumn("k", tb.per_row_k())
    f = W.sequence_features(ev, EV, "value", k_col="k", lat="lat", lon="lon", hot_threshold=th)
    cols = ["exp_mean", "exp_std", "exp_max", "value_ratio", "minutes_since_prev", "dist_prev_km", "last_k_sum"]
    return f.select("event_id", "exp_count", "prior_count", "above_2x_mean", *[Q.r6(c).alias(c) for c in cols])


def test_hot_keys_detected(spark):
    ev = tb.transactions(spark, SF_MID)
    hot = hot_key_chunks(ev, EV, 10)
    assert hot is not None and hot.count() == ev.select("user_id").distinct().count()
    assert hot_key_chunks(ev, EV, 10**9) is None


def test_sequence_features_chunked_equal(spark):
    assert_same(_seq(spark, 7).toPandas(), _seq(spark, None).toPandas())


def test_interval_counts_chunked_equal(spark):
    ev = tb.transactions(spark, SF_MID)
    widths = {"c1": 3600, "c24": 86400, "c7": 7 * 86400}
    a = W.interval_counts(ev, EV, widths, hot_threshold=5).select("event_id", "c1", "c24", "c7")
    b = W.interval_counts(ev, EV, widths).select("event_id", "c1", "c24", "c7")
    assert_same(a.toPandas(), b.toPandas())


def test_asof_chunked_equal(spark):
    left = tb.order_stream(spark, SF_MID).select("o_orderkey", "o_custkey", "o_orderdate")
    lab = Q._order_labels(spark, SF_MID).select(F.col("o_orderkey").alias("lo"), "o_custkey", "label_ts", "label")
    kw = dict(left_key="o_custkey", right_key="o_custkey", left_time="o_orderdate", right_time="label_ts",
              right_tie="lo", payload=["lo", "label_ts", "label"], prefix="r_")
    a = asof_join(left, lab, hot_threshold=4, **kw)
    b = asof_join(left, lab, **kw)
    assert_same(a.toPandas(), b.toPandas())


def test_one_hot_key_with_third_of_rows(spark):
    """One key holding a third of all rows is split into chunks and stays exact."""
    ev = tb.transactions(spark, SF_MID)
    skewed = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    hot = hot_key_chunks(skewed, EV, 500)
    assert hot is not None and [r["user_id"] for r in hot.collect()] == [-1]
    a = W.sequence_features(skewed, EV, "value", hot_threshold=500).select("event_id", Q.r6("exp_std").alias("s"), "exp_count")
    b = W.sequence_features(skewed, EV, "value").select("event_id", Q.r6("exp_std").alias("s"), "exp_count")
    assert_same(a.toPandas(), b.toPandas())


def test_interval_stats_chunked_equal(spark):
    ev = tb.transactions(spark, SF_MID)
    specs = {"s24": ("sum", 86400), "m30": ("mean", 30 * 86400), "d30": ("std", 30 * 86400),
             "x30": ("max", 30 * 86400), "n7": ("count", 7 * 86400), "x1": ("max", 86400),
             "lo7": ("min", 7 * 86400)}
    cols = ["event_id", *[Q.r6(c).alias(c) for c in ("s24", "m30", "d30", "x30", "x1", "lo7")], "n7"]
    a = W.interval_stats(ev, EV, "value", specs, hot_threshold=6).select(*cols)
    b = W.interval_stats(ev, EV, "value", specs).select(*cols)
    assert_same(a.toPandas(), b.toPandas())


def test_hot_chunks_with_null_values(spark):
    """A hot key whose early chunks hold only NULL values (ANSI: no division by zero)."""
    ev = tb.transactions(spark, SF_MID)
    nulled = ev.withColumn("value", F.when(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"),
                                           F.lit(None).cast("double")).otherwise(F.col("value")))
    cols = ["event_id", "exp_count", Q.r6("exp_mean").alias("m"), Q.r6("exp_std").alias("s"), "exp_max"]
    a = W.sequence_features(nulled, EV, "value", hot_threshold=7).select(*cols)
    b = W.sequence_features(nulled, EV, "value").select(*cols)
    assert_same(a.toPandas(), b.toPandas())


def _prior_pct_brute(df, q):
    """Spark's growing-frame percentile: O(n²) per key, small fixtures only."""
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    return (df.select("event_id", Q.r6(F.percentile(F.col("value"), F.lit(q)).over(w)).alias("p"))
              .where(F.col("p").isNotNull()))


def test_prior_quantile_radix_equals_brute_force(spark):
    """Radix descent over value ranks = growing-frame percentile, with one key
    holding a third of all rows split into chunks, NULL values, tied values,
    values cut into pieces and the extreme quantiles."""
    from quarry.operators.orderstat import prior_quantile
    ev = tb.transactions(spark, SF_MID)
    skewed = (ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
                .withColumn("value", F.when(F.col("event_id") % 7 == 0, F.lit(None))
                                      .otherwise(F.round(F.col("value") / 10))))
    for q in (0.95, 0.5, 0.0, 1.0):
        a = prior_quantile(skewed, EV, "value", q, hot_threshold=300)
        a = a.select("event_id", Q.r6("_pq").alias("p"))
        assert_same(a.toPandas(), _prior_pct_brute(skewed, q).toPandas())


def test_digit_plan():
    from quarry.operators.orderstat import digit_plan
    assert digit_plan(1) == (4, 1)
    assert digit_plan(6583) == (5, 3)          # 13 bits
    assert digit_plan(10**9) == (6, 5)         # 30 bits
    for n in (2, 17, 1000, 10**6, 10**12):
        bits, levels = digit_plan(n)
        assert bits * levels >= (n - 1).bit_length()


def test_value_rank_across_pieces(spark):
    """Places within a key, whole or cut into pieces of a few values, are those of sorting its values."""
    import pandas as pd
    from quarry.operators.orderstat import key_value_rank
    ev = tb.transactions(spark, SF_MID).withColumns({
        "user_id": F.when(F.col("event_id") % 3 > 0, F.lit(None)).otherwise(F.col("user_id")),
        "value": F.when(F.col("event_id") % 5 > 0, F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.round("value")))})
    for threshold in (None, 7):
        got = key_value_rank(ev, EV, "value", threshold).toPandas()
        assert len(got) == ev.count() and got[got._v.isna() & got._rho.notna()].event_id.mod(11).eq(0).all()
        ranked = got[got._rho.notna()].sort_values(["user_id", "_rho"])
        assert len(ranked) == ev.where("value is not null").count()
        for _, rows in ranked.groupby("user_id", dropna=False):
            assert rows._rho.tolist() == list(range(len(rows)))
            assert rows._v.reset_index(drop=True).equals(pd.Series(sorted(rows._v, key=lambda x: (np.isnan(x), x)), name="_v"))


def test_prior_quantile_edge_inputs(spark):
    """Chunked descent = growing-frame percentile on all-NULL values, one-event
    keys, integer and float32 values and a single distinct value."""
    from conftest import SF_SMALL
    ev = tb.transactions(spark, SF_SMALL)
    cases = [ev.withColumn("value", F.lit(None).cast("double")),
             ev.withColumn("user_id", F.col("event_id")),
             ev.withColumn("value", F.floor("value").cast("int")),
             ev.withColumn("value", F.col("value").cast("float")),
             ev.withColumn("value", F.lit(3.5))]
    for df in cases:
        got = W.prior_quantile_flag(df, EV, "value", 0.95, hot_threshold=40)
        got = got.select("event_id", Q.r6(F.col("prior_p95").cast("double")).alias("p")).where("p is not null")
        assert_same(got.toPandas(), _prior_pct_brute(df.withColumn("value", F.col("value").cast("double")), 0.95).toPandas())


def _hard_events(spark):
    """Large offset, NaN, infinities, NULL values, a NULL key with most rows and a one-second burst."""
    rows = spark.range(600).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 > 0, F.lit(None)).otherwise(F.col("id") % 2).cast("long").alias("user_id"),
        F.timestamp_seconds(F.when(F.col("id").between(200, 420), F.lit(2000) + F.col("id") % 5)
                             .otherwise(F.col("id") * 7)).cast("timestamp_ntz").alias("ts"),
        (F.lit(1e8) + F.col("id") % 3).alias("value"), (F.col("id") % 20 + 1).cast("int").alias("k"))
    return rows.withColumn("value", F.when(F.col("event_id") % 41 == 0, F.lit(None)).otherwise(F.col("value")))


def test_sequence_features_hard_rows(spark):
    ev = _hard_events(spark)
    got = W.sequence_features(ev, EV, "value", k_col="k", hot_threshold=25).toPandas().set_index("event_id")
    pdf = ev.toPandas().sort_values(["ts", "event_id"])
    for _, g in pdf.groupby("user_id", dropna=False):
        vals = g["value"].to_numpy()
        for i, r in enumerate(g.itertuples()):
            head = vals[:i + 1][~np.isnan(vals[:i + 1])]
            row = got.loc[r.event_id]
            assert row["exp_count"] == i + 1
            if len(head):
                assert abs(row["exp_std"] - head.std()) < 1e-6 and abs(row["exp_mean"] - head.mean()) < 1e-6
            assert row["last_k_sum"] == np.nansum(vals[max(0, i + 1 - r.k):i + 1])


def test_last_k_beyond_twelve(spark):
    ev = spark.range(20).select(F.col("id").alias("event_id"), F.lit(1).cast("long").alias("user_id"),
                                F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("value"), F.lit(20).alias("k"))
    assert W.sequence_features(ev, EV, "value", k_col="k").agg(F.max("last_k_sum")).first()[0] == 20.0


def test_interval_stats_hard_rows(spark):
    ev = _hard_events(spark).withColumn("value", F.when(F.col("event_id") == 60, F.lit(float("nan")))
                                        .when(F.col("event_id") == 90, F.lit(float("inf"))).otherwise(F.col("value")))
    specs = {"s": ("sum", 300), "m": ("mean", 300), "d": ("std", 300), "n": ("count", 300), "x": ("max", 300)}
    pdf = ev.select("event_id", "user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"), "value",
                    F.col("value").isNull().alias("none")).toPandas()
    for threshold in (25, None):
        got = W.interval_stats(ev, EV, "value", specs, hot_threshold=threshold).toPandas().set_index("event_id")
        for _, g in pdf.groupby("user_id", dropna=False):
            for r in g.itertuples():
                v = g[(g.t >= r.t - 300) & (g.t <= r.t) & ~g.none]["value"].to_numpy()
                row = got.loc[r.event_id]
                assert row["n"] == len(v)
                if len(v):
                    assert np.isclose(row["m"], v.mean(), rtol=1e-12, equal_nan=True)
                    if np.isfinite(v).all():
                        assert abs(row["d"] - v.std()) < 1e-6 and row["x"] == v.max() and np.isclose(row["s"], v.sum(), rtol=1e-12)
                    else:
                        assert np.isnan(row["d"])


def test_chunks_are_balanced_under_bursts(spark):
    from quarry.operators.keyed import CHUNK, with_chunks
    ev = _hard_events(spark)
    sizes = with_chunks(ev, EV, hot_key_chunks(ev, EV, 50)).groupBy("user_id", CHUNK).count().toPandas()
    assert sizes[sizes.user_id.isna()]["count"].max() <= 120  # 400 NULL-key rows, 221 of them within five seconds


def test_asof_null_rules(spark):
    left = spark.createDataFrame([(1, "a", 10), (2, None, 10), (3, "a", None), (4, "b", 10)], "id int, k string, t long")
    right = spark.createDataFrame([("a", 5, 1, "old"), (None, 5, 2, "nobody"), ("a", None, 3, "undated"), ("b", None, 4, "undated")],
                                  "k string, t long, tie int, label string")
    stamped = [df.withColumn("t", F.timestamp_seconds("t")) for df in (left, right)]
    for threshold in (1, None):
        got = asof_join(*stamped, left_key="k", right_key="k", left_time="t", right_time="t", right_tie="tie",
                        payload=["label"], hot_threshold=threshold).collect()
        assert {r.id: r.label for r in got} == {1: "old", 2: None, 3: None, 4: None}
