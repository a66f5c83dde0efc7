"""Hand-worked metric values (ties, zero denominators, one class)."""

import random

import pytest

from quarry.operators import metrics as mt


def brute_ap(y, s):
    # sum over distinct thresholds (desc) of (R_n - R_{n-1}) * P_n
    P = sum(y)
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        sel = [yy for yy, ss in zip(y, s) if ss >= t]
        tp = sum(sel)
        r, p = tp / P, tp / len(sel)
        ap += (r - prev_r) * p
        prev_r = r
    return ap


def brute_auc(y, s):
    pos = [ss for yy, ss in zip(y, s) if yy == 1]
    neg = [ss for yy, ss in zip(y, s) if yy == 0]
    tot = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return tot / (len(pos) * len(neg))


CASES = [
    ([1, 0, 1, 1, 0, 0], [0.9, 0.8, 0.8, 0.4, 0.4, 0.1]),
    ([1, 1, 0, 0, 1, 0, 0, 1], [0.5, 0.5, 0.5, 0.2, 0.9, 0.9, 0.1, 0.3]),
    ([0, 1], [0.3, 0.3]),
]


def frame(spark, y, s):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(y, s))], "id int, y int, s double")


@pytest.fixture(params=[1, 3, 64])
def ranges(spark, request):
    """Scores in about that many ranges: small ones are not merged."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    for k, v in keep.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("y,s", CASES)
def test_ap_auc_with_ties(spark, ranges, y, s):
    r = mt.ranking_metrics(frame(spark, y, s), "y", "s").first()
    assert r["average_precision"] == pytest.approx(brute_ap(y, s), abs=1e-12)
    assert r["roc_auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)


def test_groups_in_ranges(spark, ranges):
    """Ranges that hold the end of one group and the beginning of the next, a NULL group among them."""
    rnd = random.Random(3)
    rows = [(rnd.choice([None, "a", "b"]), rnd.randrange(2), rnd.randrange(25) / 25) for _ in range(300)]
    got = {r["g"]: r for r in mt.ranking_metrics(spark.createDataFrame(rows, "g string, y int, s double"), "y", "s", ["g"]).collect()}
    assert set(got) == {None, "a", "b"}
    for g, r in got.items():
        y, s = [x[1] for x in rows if x[0] == g], [x[2] for x in rows if x[0] == g]
        assert r["average_precision"] == pytest.approx(brute_ap(y, s), abs=1e-12)
        assert r["roc_auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)


def test_ap_step_not_trapezoid(spark):
    y, s = CASES[0]
    r = mt.ranking_metrics(frame(spark, y, s), "y", "s").first()
    assert r["average_precision"] == pytest.approx(0.7555555555, abs=1e-9)


def test_auc_null_for_one_class(spark):
    r = mt.evaluate_binary(frame(spark, [1, 1, 1], [0.2, 0.6, 0.9]), "y", "s").first()
    assert r["roc_auc"] is None
    assert r["average_precision"] == pytest.approx(1.0)


def test_zero_division_is_zero(spark):
    r = mt.threshold_metrics(frame(spark, [0, 0, 1], [0.1, 0.2, 0.3]), "y", "s", 0.5).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)


def test_threshold_is_inclusive(spark):
    r = mt.threshold_metrics(frame(spark, [1, 0], [0.5, 0.49]), "y", "s", 0.5).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (1, 0, 0, 1)


def test_grouped_metrics(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.2), ("b", 0, 0.8)], "g string, y int, s double")
    r = {x["g"]: x for x in mt.ranking_metrics(df, "y", "s", group_by=["g"]).collect()}
    assert r["a"]["roc_auc"] == 1.0 and r["b"]["roc_auc"] == 0.0


def test_logloss_clipped(spark):
    r = mt.logloss_accuracy(frame(spark, [1, 0], [1.0, 0.0]), "y", "s").first()
    assert r["accuracy"] == 1.0
    assert r["log_loss"] < 1e-12


def test_null_group_is_kept(spark):
    df = spark.createDataFrame([(None, 1, 0.9), (None, 0, 0.1), ("a", 1, 0.2), ("a", 0, 0.7)], "g string, y int, s double")
    got = {r["g"]: r for r in mt.evaluate_binary(df, "y", "s", group_by=["g"]).collect()}
    assert set(got) == {None, "a"} and got[None]["roc_auc"] == 1.0 and got["a"]["roc_auc"] == 0.0
    assert (got[None]["tp"], got[None]["tn"], got["a"]["fp"], got["a"]["fn"]) == (1, 1, 1, 1)
