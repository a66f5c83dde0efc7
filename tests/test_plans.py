"""Physical-plan properties the operators promise."""

from quarry.plans import queries as Q

from conftest import SF_MID


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_one_exchange_no_python(spark):
    p = plan(Q.feat_all(spark, SF_MID))
    assert p.count("Exchange hashpartitioning") == 1
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_label_filter_pushed_and_text_pruned(spark):
    df = Q.labeled_rows(spark, SF_MID)
    p = plan(df)
    assert "IsNotNull" in p
    scans = [l for l in p.splitlines() if "ReadSchema" in l and "documents" in l]
    assert scans and all("text" not in l.split("ReadSchema")[1] for l in scans)


def test_snapshot_asof_filter_pushed(spark):
    p = plan(Q.feature_snapshot_asof(spark, SF_MID))
    assert "PushedFilters: [IsNotNull(ts), LessThanOrEqual(ts" in p


def test_stable_split_no_shuffle(spark):
    p = plan(Q.stable_split(spark, SF_MID))
    assert "Window" not in p


def test_no_python_udf_anywhere(spark):
    for k in ["batch_score", "asof_label_join", "average_precision", "stratified_split", "one_hot"]:
        p = plan(Q.QUERIES[k](spark, SF_MID))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, k


def test_prior_quantile_no_frame_percentile(spark):
    """W11 runs as rank-prefix windows, not a re-sorted growing frame."""
    from quarry.operators import windows as W
    from quarry.sources import tables as tb
    ev = tb.transactions(spark, SF_MID)
    p = plan(W.prior_quantile_flag(ev, Q.EV, "value"))
    assert "percentile(" not in p.lower()
    windows = [line for line in p.splitlines() if "Window [" in line]
    assert windows and all("_pre#" in line for line in windows)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
