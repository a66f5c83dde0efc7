"""Moving frames hold only their own rows: level shifts, absurd values, hot keys, ties, NULLs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import windows as W
from quarry.operators.keyed import EventOrder

EV = EventOrder("k", "ts", "id")


def frame(spark, rows):
    """rows: (key, second, value)."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, k long, s double, v double")
    return df.select("id", "k", F.timestamp_micros((F.col("s") * 1e6).cast("long")).cast("timestamp_ntz").alias("ts"), "v").repartition(4)


def check(spark, rows, width, thresholds=(None, 40, 7), stats=("count", "sum", "mean", "std", "max", "min")):
    df = frame(spark, rows)
    t = np.array([np.nan if r[1] is None else r[1] for r in rows])
    v = np.array([np.nan if r[2] is None else r[2] for r in rows])
    there = np.array([r[2] is not None for r in rows])
    for threshold in thresholds:
        got = W.interval_stats(df, EV, "v", {s: (s, width) for s in stats}, hot_threshold=threshold).toPandas().set_index("id").sort_index()
        assert len(got) == len(rows)
        for i, (k, s, _) in enumerate(rows):
            same = np.array([r[0] == k for r in rows])
            x = v[same & there & ((np.isnan(t) if s is None else (t >= s - width) & (t <= s)))]
            r = got.loc[i]
            assert r["count"] == len(x)
            if not len(x):
                assert r[["sum", "mean", "std", "max", "min"]].isna().all()
                continue
            scale = np.abs(x).max()
            assert r["max"] == x.max() and r["min"] == x.min()
            assert abs(r["sum"] - x.sum()) <= 1e-15 * len(x) * scale + 1e-12 and abs(r["mean"] - x.mean()) <= 1e-14 * scale + 1e-14
            assert abs(r["std"] - x.std()) <= 1e-7 * max(x.std(), scale * 1e-8)


def test_level_shift(spark):
    """1,000 zeros, then 1,000 values near 1e8; nine-minute frames in the upper level keep their deviation."""
    rows = [(1, 60.0 * i, 0.0 if i < 1000 else 1e8 + i % 3) for i in range(2000)]
    df = frame(spark, rows)
    for threshold in (None, 300):
        got = W.interval_stats(df, EV, "v", {"d": ("std", 540), "s": ("sum", 540)}, hot_threshold=threshold).toPandas().set_index("id")
        for i in (500, 1015, 1500, 1999):
            x = np.array([r[2] for r in rows[i - 9:i + 1]])
            assert abs(got.d[i] - x.std()) < 1e-9 and got.s[i] == x.sum()


def test_one_absurd_value_leaves_with_its_frames(spark):
    rows = [(1, float(i), 1e17 if i == 50 else 1.0) for i in range(400)]
    df = frame(spark, rows)
    for threshold in (None, 30):
        got = W.interval_stats(df, EV, "v", {"s": ("sum", 9), "m": ("mean", 9), "d": ("std", 9)}, hot_threshold=threshold).toPandas().set_index("id")
        for i in range(60, 400):
            assert (got.s[i], got.m[i], got.d[i]) == (10.0, 1.0, 0.0)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_events_against_brute_force(spark, seed):
    """Bursts, ties, times before 1970 and at tile bounds, NULL keys, values and times; two thirds of the rows in one key."""
    r = np.random.default_rng(seed)
    rows = []
    for i in range(500):
        key = None if i % 3 == 0 else int(r.integers(0, 3)) if i % 3 == 1 else 7
        second = float(r.integers(-300, 900)) if i % 4 else float(r.integers(0, 8)) * 100
        rows.append((key, None if i % 37 == 0 else second, None if i % 11 == 0 else float(r.normal() * 10 ** r.integers(0, 6))))
    rows = [x if x[0] is not None else (None, x[1], x[2]) for x in rows]
    check(spark, rows, int(r.choice([1, 100, 350, 5000])))


def test_a_key_in_one_tile_is_cut_into_pieces(spark):
    """All rows of a hot key in one tile of the frame's width, and in two."""
    for first in (0.0, 950.0):
        check(spark, [(5, first + i * 0.1, float((i * 7919) % 101)) for i in range(700)], 1000, thresholds=(20, 101))


def test_values_that_are_not_finite(spark):
    rows = [(1, float(i), float("nan") if i == 20 else float("inf") if i == 40 else float(i)) for i in range(80)]
    df = frame(spark, rows)
    for threshold in (None, 9):
        got = W.interval_stats(df, EV, "v", {"s": ("sum", 5), "d": ("std", 5), "x": ("max", 5)}, hot_threshold=threshold).toPandas().set_index("id")
        for i in range(80):
            odd = 20 <= i <= 25 or 40 <= i <= 45
            assert np.isfinite(got.s[i]) != odd and np.isnan(got.d[i]) == odd
        assert got.x[44] == float("inf") and got.x[46] == 46.0


def test_position_in_bounds(spark):
    from quarry.operators.keyed import position_in
    df = spark.range(-3, 40).select("id", F.explode(F.array(*[F.sequence(F.lit(1), F.lit(n)) if n else F.array().cast("array<int>") for n in (0, 1, 2, 3, 7, 8, 31)])).alias("b"))
    bad = df.where(position_in("b", F.col("id")) != F.size(F.filter("b", lambda x: x <= F.col("id"))))
    assert bad.count() == 0
