"""Guards: missing columns, empty input, single class, quantiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import dataset as ds
from quarry.operators import prep
from quarry.spec import FeatureSpec, require_columns

SPEC = FeatureSpec(metadata=("id",), numeric=("x",), categorical=("c",), target="y")


def test_require_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, x double")
    with pytest.raises(ValueError, match="training.*'c'"):
        require_columns(df, SPEC.training_columns, "training")


def test_empty_and_single_class(spark):
    df = spark.createDataFrame([(1, 2.0, "a", None)], "id int, x double, c string, y int")
    lab = ds.labeled_rows(df, SPEC)
    with pytest.raises(RuntimeError):
        ds.require_rows(lab, "training")
    one = spark.createDataFrame([(1, 2.0, "a", 1), (2, 3.0, "b", 1)], "id int, x double, c string, y int")
    with pytest.raises(RuntimeError):
        ds.require_two_classes(ds.labeled_rows(one, SPEC), "y")


def test_labelled_unlabelled_cover(spark):
    df = spark.range(100).select(F.col("id"), F.col("id").cast("double").alias("x"), F.lit("a").alias("c"),
                                 F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 2).cast("int").alias("y"))
    a = {r["id"] for r in ds.labeled_rows(df, SPEC).collect()}
    b = {r["id"] for r in ds.unlabeled_rows(df, SPEC).collect()}
    assert not (a & b) and len(a | b) == 100


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_exact_quantiles_small_buckets(spark, n):
    rng = np.random.default_rng(n)
    vals = np.round(rng.normal(size=n) * 10, 1)  # duplicates
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = prep.exact_quantiles(df, "v", [0.5, 0.95, 0.0, 1.0])
    for p, g in got.items():
        assert g == pytest.approx(float(np.quantile(vals, p)), abs=1e-9)


def test_quantiles_of_hard_columns(spark):
    """NULL and NaN have no rank, infinities have; a wide spread and one value settle in a few rounds."""
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    wide = [float(x) for x in rng.normal(size=300) * 10.0 ** rng.integers(-300, 300, size=300)]
    cols = {"odd": [1.0, 2.0, 3.0, nan, nan, None], "one": [1.0, nan, nan], "ends": [-inf, -inf, 1.0, 2.0, inf, inf, inf], "none": [None, nan],
            "big": [1e8 + i % 3 for i in range(100)], "wide": wide, "whole": [2**53 + float(i) for i in range(9)]}
    n = max(map(len, cols.values()))
    rows = list(zip(*[v + [None] * (n - len(v)) for v in cols.values()]))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    got = prep.column_quantiles(df, list(cols), [0.5, 0.9])
    for c, v in cols.items():
        there = sorted(x for x in v if x is not None and x == x)
        for p in (0.5, 0.9):
            if not there:
                assert got[c][p] is None
                continue
            h = (len(there) - 1) * p
            a, b = there[int(h)], there[min(int(h) + 1, len(there) - 1)]
            assert got[c][p] == (a if h == int(h) or a == b else a + (b - a) * (h - int(h))), c


def test_profile_of_any_type(spark):
    from quarry.operators.monitor import feature_profile
    df = spark.createDataFrame([("a", True, 2**60 + 1), ("b", None, 2**60 + 2), (None, False, 2**60 + 3)], "s string, b boolean, n long")
    got = {r["column_name"]: r for r in feature_profile(df, ["s", "b", "n"]).collect()}
    assert [got[c]["n_distinct"] for c in ("s", "b", "n")] == [2, 2, 3]
    assert got["s"]["min_value"] is None and got["b"]["mean_value"] == 0.5 and abs(got["s"]["null_rate"] - 1 / 3) < 1e-12


def test_dataset_names(spark):
    from quarry.functions.scalar import split_dataset_name, version_string
    r = spark.range(1).select(split_dataset_name("a.b", "train", 3), split_dataset_name("a.b", "test"), version_string(F.col("id"))).first()
    assert tuple(r) == ("a_b_train_v3", "a_b_test", "0")


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert prep.fit_modes(df, ["c"]) == {"c": "a"}


def test_lineage_cut_lands_in_session_checkpoint_dir(spark):
    """Cuts are written under the folder the session names in
    spark.checkpoint.dir (set by the cluster; by conftest in tests)."""
    from quarry.session import cut_lineage
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    cut = cut_lineage(spark.range(10), "probe")
    files = cut.inputFiles()
    assert files and all(root.rstrip("/") in f for f in files)
    assert cut.count() == 10
