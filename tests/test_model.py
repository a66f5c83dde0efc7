"""Model fit / score / persistence on the documents fixture."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import boosting
from quarry.operators import dataset as ds
from quarry.operators.metrics import ranking_metrics
from quarry.operators.model import FittedModel, fit_model
from quarry.plans import queries as Q

from conftest import SF_MID


def test_fit_score_save_load(spark, tmp_dir):
    lab = ds.labeled_rows(Q._docs(spark, SF_MID), Q.DOC_SPEC)
    m = fit_model(lab, Q.DOC_SPEC, {"n_estimators": 5, "max_depth": 3})
    scored = m.predict_proba(lab)
    assert scored.where(F.col("score").isNull() | (F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    auc = ranking_metrics(scored, "label", "score").first()["roc_auc"]
    assert auc > 0.5
    imp = m.feature_importance()
    assert abs(sum(v for _, v in imp) - 1.0) < 1e-9
    assert any(n.startswith("lang_") for n, _ in imp)
    m.save(tmp_dir + "/model")
    m2 = FittedModel.load(tmp_dir + "/model", Q.DOC_SPEC)
    a = [r["score"] for r in m.predict_proba(lab).orderBy("doc_id").collect()]
    b = [r["score"] for r in m2.predict_proba(lab).orderBy("doc_id").collect()]
    assert a == b and m2.params["max_depth"] == 3


def test_unseen_category_scores(spark):
    lab = ds.labeled_rows(Q._docs(spark, SF_MID), Q.DOC_SPEC)
    m = fit_model(lab.where(F.col("lang") != "fr"), Q.DOC_SPEC, {"n_estimators": 3, "max_depth": 2})
    fr = lab.where(F.col("lang") == "fr")
    assert m.predict_proba(fr).where(F.col("score").isNull()).count() == 0


def test_modes_with_quotes_and_exact_medians_survive_saving(spark, tmp_dir):
    from quarry.operators.model import ExactStatistics, ExactStatisticsModel
    from quarry.operators.prep import fit_medians
    odd = "a\\b'c\\\\n"
    df = spark.createDataFrame([(odd, 0.1, True), (odd, 0.2, None), (None, None, False), ("z", 1e300, None), (None, float("nan"), None)],
                               "c string, x double, b boolean").withColumn("none", F.lit(None).cast("double"))
    m = ExactStatistics(numericCols=["x", "none"], categoricalCols=["c"], booleanCols=["b"]).fit(df)
    m.write().overwrite().save(tmp_dir + "/stats")
    for model in (m, ExactStatisticsModel.load(tmp_dir + "/stats")):
        out = model.transform(df).collect()
        median = fit_medians(df, ["x"])["x"]
        assert [r["x__num"] for r in out] == [0.1, 0.2, median, 1e300, median]
        assert {r["c__cat"] for r in out} == {odd, "z"} and {r["none__num"] for r in out} == {None}
        assert [r["b__cat"] for r in out] == ["true", "__null__", "false", "__null__", "__null__"]


def plain_tree(x, g, h, depth, p):
    """One tree by exhaustive search over raw values (NaN is missing), as nested tuples or a leaf value."""
    def score(gs, hs):
        return gs * gs / (hs + p["l2"])
    best = None
    for c in range(x.shape[1]) if depth else ():
        known = ~np.isnan(x[:, c])
        for cut in np.unique(x[known, c]):
            for missing_left in (True, False):
                left = np.where(known, x[:, c] <= cut, missing_left)
                hl, hr = h[left].sum(), h[~left].sum()
                if hl < p["min_child_weight"] or hr < p["min_child_weight"]:
                    continue
                gain = score(g[left].sum(), hl) + score(g[~left].sum(), hr) - score(g.sum(), h.sum())
                if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, c, cut, missing_left, left)
    if best is None:
        return -g.sum() / (h.sum() + p["l2"]) * p["learning_rate"]
    _, c, cut, missing_left, left = best
    return c, cut, missing_left, plain_tree(x[left], g[left], h[left], depth - 1, p), plain_tree(x[~left], g[~left], h[~left], depth - 1, p)


def plain_value(tree, row):
    while isinstance(tree, tuple):
        c, cut, missing_left, a, b = tree
        tree = a if (missing_left if np.isnan(row[c]) else row[c] <= cut) else b
    return tree


@pytest.mark.parametrize("rows_per_task", [10**6, 90])
def test_boosting_equals_a_plain_single_process_learner(spark, rows_per_task):
    """Missing values with a learned side, several tasks or one; no sampling, so that the trees are the same."""
    r = np.random.default_rng(6)
    x = np.round(r.normal(size=(240, 3)) * 4)
    x[r.random(x.shape) < 0.15] = np.nan
    y = (np.nan_to_num(x[:, 0], nan=3) + np.nan_to_num(x[:, 1]) ** 2 / 4 + r.normal(size=240) > 3).astype(float)
    params = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3, "subsample": 1.0, "colsample": 1.0, "rows_per_task": rows_per_task}
    df = spark.createDataFrame([(*[None if np.isnan(v) else float(v) for v in row], int(t)) for row, t in zip(x, y)], "a double, b double, c double, y int")
    layout, base, trees = boosting.fit_trees(df, ["a", "b", "c"], [], "y", params)
    p = {**boosting.DEFAULTS, **params}
    margin = np.full(240, np.log(y.mean() / (1 - y.mean())))
    for _ in range(4):
        prob = 1 / (1 + np.exp(-margin))
        tree = plain_tree(x, prob - y, prob * (1 - prob), 3, p)
        margin = margin + np.array([plain_value(tree, row) for row in x])
    assert np.abs(boosting.margins(trees, base, list(x.T), layout) - margin).max() < 1e-9


def test_boosting_samples_rows_and_columns_and_handles_categories(spark):
    r = np.random.default_rng(7)
    rows = [(float(r.normal()), int(c), int(c == 2) if r.random() < 0.9 else int(r.integers(0, 2))) for c in r.integers(0, 4, 600)]
    df = spark.createDataFrame(rows, "x double, c int, y int")
    layout, base, trees = boosting.fit_trees(df, ["x"], ["c"], "y", {"n_estimators": 20})
    seen = boosting.margins(trees, base, [np.array([0.0] * 6), np.array([0, 1, 2, 3, 9, np.nan])], layout)
    assert seen[2] > 0.5 and (seen[[0, 1, 3]] < 0).all() and seen[4] == seen[5]
    assert len({json.dumps(t) for t in trees}) == 20  # other rows and columns each time
    again = boosting.fit_trees(df.repartition(5), ["x"], ["c"], "y", {"n_estimators": 20})
    assert again == (layout, base, trees)  # whatever the partitioning
    with pytest.raises(ValueError):
        boosting.fit_trees(df.where("y = 1"), ["x"], ["c"], "y", {})
