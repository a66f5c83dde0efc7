"""Sum of the last k rows with k per row: short and long k, hot keys, NULLs, values that do not cancel."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import lastk
from quarry.operators import windows as W
from quarry.operators.keyed import EventOrder

EV = EventOrder("key", "ts", "id")


def frame(spark, rows):
    """rows: (key, value, k); time is the row's place, three rows a second."""
    df = spark.createDataFrame([(i, key, i // 3, v, k) for i, (key, v, k) in enumerate(rows)], "id long, key long, s long, v double, k long")
    return df.select("id", "key", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "v", "k").repartition(4)


def brute(rows):
    seen, out = {}, []
    for key, v, k in rows:
        past = seen.setdefault(key, [])
        past.append(0.0 if v is None else v)
        out.append(float(np.sum(past[-max(1, k or 1):])))
    return out


@pytest.mark.parametrize("threshold", [None, 150, 20, 7])
def test_short_and_long_k(spark, threshold):
    r = np.random.default_rng(1)
    rows = [(None if i % 3 == 0 else int(i % 5 == 0), None if i % 13 == 0 else float(r.integers(0, 1000)),
             None if i % 17 == 0 else int(r.choice([0, 1, 2, 15, 16, 17, 31, 32, 33, 64, 100, 1_000_000]))) for i in range(900)]
    got = W.sequence_features(frame(spark, rows), EV, "v", k_col="k", hot_threshold=threshold).toPandas().set_index("id").sort_index()
    assert got.last_k_sum.tolist() == brute(rows)


def test_one_absurd_value_leaves_with_its_frames(spark):
    rows = [(1, 1e17 if i == 100 else 1.0, 40) for i in range(300)]
    got = W.sequence_features(frame(spark, rows), EV, "v", k_col="k").toPandas().set_index("id").sort_index()
    assert got.last_k_sum.tolist()[140:] == [40.0] * 160


def test_no_list_follows_k(spark):
    """The plan holds no list of frame values; without a long k the sum comes from the features' own window."""
    short = W.sequence_features(frame(spark, [(1, 1.0, 5)] * 30), EV, "v", k_col="k")
    plan = short._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and plan.count("Window [") == 1 and "Join" not in plan
    assert lastk.has_long(frame(spark, [(1, 1.0, 17)]), "k") and not lastk.has_long(frame(spark, [(1, 1.0, 16)]), "k")


def test_one_long_k_costs_little(spark):
    """A million rows of one key, one with k = 10^6: nodes looked up, not values."""
    import time
    df = spark.range(1_000_000).select("id", F.lit(1).cast("long").alias("key"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"),
                                       F.lit(1.0).alias("v"), F.when(F.col("id") == 999_999, 1_000_000).otherwise(3).alias("k"))
    began = time.perf_counter()
    top = W.sequence_features(df, EV, "v", k_col="k", hot_threshold=200_000).agg(F.max("last_k_sum").alias("m"), F.sum("last_k_sum").alias("s")).first()
    assert (top.m, top.s) == (1_000_000.0, 1_000_000.0 + 3 * 999_997 + 3)
    assert time.perf_counter() - began < 90
