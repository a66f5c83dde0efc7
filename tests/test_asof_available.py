"""As-of join on two time axes against plain loops: ties, NULLs on both axes, a hot key, chunked plans."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators.asof_available import asof_available_join

LEFT = "id int, k string, t long, c long"
RIGHT = "k string, e long, a long, tie int, label string"


def _frames(spark, seed):
    rnd = random.Random(seed)
    gap = lambda x: None if rnd.random() < 0.05 else x
    key = lambda: gap("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(12)}")
    left = [(i, key(), gap(rnd.randrange(60)), gap(rnd.randrange(90))) for i in range(600)] * 2
    right = [(key(), gap(rnd.randrange(60)), gap(rnd.randrange(90)), i, f"l{i}") for i in range(500)]
    return left, right


def _want(left, right):
    out = []
    for i, k, t, c in left:
        known = [(e, tie, label) for rk, e, a, tie, label in right
                 if None not in (k, t, c, e, a) and rk == k and e <= t and a <= c]
        out.append((i, max(known)[2] if known else None))
    return sorted(out, key=str)


def _join(spark, left, right, threshold=None, repartition=None):
    a = spark.createDataFrame(left, LEFT).withColumns({x: F.timestamp_seconds(x) for x in "tc"})
    b = spark.createDataFrame(right, RIGHT).withColumns({x: F.timestamp_seconds(x) for x in "ea"})
    if repartition:
        a, b = a.repartition(repartition), b.repartition(repartition)
    return asof_available_join(a, b, left_key="k", right_key="k", left_time="t", left_cutoff="c", right_time="e",
                               right_available="a", right_tie="tie", payload=["label"], prefix="r_", hot_threshold=threshold)


@pytest.mark.parametrize("threshold", [None, 150, 9])
def test_against_loops(spark, threshold):
    left, right = _frames(spark, 5)
    got = sorted(((r.id, r.r_label) for r in _join(spark, left, right, threshold, 3).collect()), key=str)
    assert got == _want(left, right)
    assert sum(x is not None for _, x in got) > 300


def test_empty_sides(spark):
    left, right = _frames(spark, 6)
    assert _join(spark, left[:0], right).count() == 0
    none = _join(spark, left[:40], right[:0])
    assert none.columns == ["id", "k", "t", "c", "r_label"] and none.where("r_label is not null").count() == 0
    assert none.count() == 40


def test_blocks_of_a_prefix(spark):
    """Each rank below p shares exactly one block with p, no other rank shares any."""
    from quarry.operators.asof_available import _blocks
    size = 37
    p = spark.range(1, size + 1).select(F.col("id").alias("p"), F.explode(_blocks(F.col("id"), F.col("id"), 1)).alias("b"))
    r = spark.range(size).withColumn("n", F.lit(size).cast("long")).select(
        F.col("id").alias("r"), F.explode(_blocks(F.col("id"), F.col("n"), 0)).alias("b"))
    shared = sorted((x.p, x.r) for x in p.join(r, "b").collect())
    assert shared == [(a, b) for a in range(1, size + 1) for b in range(a)]
    assert r.groupBy("r").count().agg(F.max("count")).first()[0] <= 6


@pytest.mark.parametrize("threshold", [None, 40])
def test_leaf_edges(spark, threshold):
    """Keys around whole leaves; labels that come late send most questions to the leaves before."""
    from quarry.operators.asof_available import LEAF
    rnd = random.Random(8)
    left, right = [], []
    for n in (1, LEAF - 1, LEAF, LEAF + 1, 2 * LEAF, 2 * LEAF + 1, 5 * LEAF + 3):
        right += [(f"k{n}", e, e + rnd.choice([0, 200, 400]), e, f"l{n}-{e}") for e in range(n)]
        left += [(1000 * n + t, f"k{n}", t, rnd.choice([t - LEAF, t - 2 * LEAF, t, 900])) for t in range(-1, n + 2)]
    got = sorted(((r.id, r.r_label) for r in _join(spark, left, right, threshold, 3).collect()), key=str)
    assert got == _want(left, right)


def test_small_keys_are_not_copied_into_blocks(spark, monkeypatch):
    """Keys within one leaf are answered there; of longer ones only the unanswered ask the blocks."""
    from quarry.operators import asof_available as A
    seen, sweep = [], A._latest_available

    def counted(rows, threshold):
        seen.append({r["_side"]: r["count"] for r in rows.groupBy("_side").count().collect()})
        return sweep(rows, threshold)

    monkeypatch.setattr(A, "_latest_available", counted)
    left = [(100 * k + t, f"k{k}", t, t + k % 3) for k in range(30) for t in range(20)]
    right = [(f"k{k}", t, t + 5 * (t % 2), t, f"l{t}") for k in range(30) for t in range(20)]
    got = sorted(((r.id, r.r_label) for r in _join(spark, left, right).collect()), key=str)
    assert got == _want(left, right) and seen == [{}]
    left = [(t, "long", t, t - 70 if t == 100 else t) for t in range(120)]
    right = [("long", t, t, t, f"l{t}") for t in range(120)]
    got = sorted(((r.id, r.r_label) for r in _join(spark, left, right).collect()), key=str)
    assert got == _want(left, right)
    assert seen[1:] == [{A.LEFT: 1, A.RIGHT: 96}]


def test_named_hot_keys_are_counted_once(spark):
    """A written table of hot keys: plans that use it neither count nor cut again."""
    from quarry.operators.keyed import EventOrder, hot_key_chunks
    df = spark.range(400).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    df = df.where((F.col("k") == 3) | (F.col("t") < 100))
    order = EventOrder("k", "t", "t")
    plain = hot_key_chunks(df, order, 20, F.col("t"))
    named = hot_key_chunks(df, order, 20, F.col("t"), name="hot-test")
    assert plain.collect() == named.collect() != []
    text = lambda x: x._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in text(plain) and "Aggregate" not in text(named)
    assert hot_key_chunks(df, order, 1000, F.col("t"), name="hot-test") is None
