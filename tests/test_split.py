"""Split invariants and guards."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import split as sp
from quarry.spec import check_split_fractions


def data(spark, n=2000):
    return spark.range(n).select(F.col("id").alias("rid"), (F.col("id") % 5 == 0).cast("int").alias("y"))


def test_exact_split_partitions_and_quotas(spark):
    df = data(spark)
    s = sp.stratified_split(df, "rid", "y", 0.2, 0.1, seed=7)
    assert s.count() == 2000
    counts = {(r["split"], r["y"]): r["n_rows"] for r in sp.split_counts(s, "y").collect()}
    # class 1: 400 rows → 280/80/40 ; class 0: 1600 → 1120/320/160
    assert counts[("train", 1)] == 280 and counts[("validation", 1)] == 80 and counts[("test", 1)] == 40
    assert counts[("train", 0)] == 1120 and counts[("validation", 0)] == 320 and counts[("test", 0)] == 160


def test_exact_split_matches_rank_definition(spark):
    """The histogram cuts give the rank definition."""
    df = data(spark, 500)
    got = {r["rid"]: r["split"] for r in
           sp.stratified_split(df, "rid", "y", 0.25, 0.15, seed=3).collect()}
    import hashlib
    want = {}
    rows = [(r["rid"], r["y"]) for r in df.collect()]
    for cls in (0, 1):
        ids = [i for i, y in rows if y == cls]
        ids.sort(key=lambda i: (int(hashlib.md5(f"3:{i}".encode()).hexdigest()[:15], 16), i))
        n = len(ids)
        qt = int((n * (1 - 0.25 - 0.15)) + 0.5)
        qv = int((n * (1 - 0.15)) + 0.5)
        for rk, i in enumerate(ids, 1):
            want[i] = "train" if rk <= qt else "validation" if rk <= qv else "test"
    assert got == want


def test_split_of_repeated_ids_counts_ids(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("rid"), F.lit(1).alias("y"))
    got = {(r["rid"], r["split"]) for r in sp.stratified_split(df, "rid", "y", 0.2, 0.1).collect()}
    parts = [p for _, p in got]
    assert len(got) == 10 and (parts.count("train"), parts.count("validation"), parts.count("test")) == (7, 2, 1)


def test_split_independent_of_partitioning(spark):
    df = data(spark)
    a = {r["rid"]: r["split"] for r in sp.stratified_split(df, "rid", "y", 0.2, 0.1).collect()}
    b = {r["rid"]: r["split"] for r in sp.stratified_split(df.repartition(13), "rid", "y", 0.2, 0.1).collect()}
    assert a == b
    c = {r["rid"]: r["split"] for r in sp.stable_split(df, "rid", 0.2, 0.1).collect()}
    d = {r["rid"]: r["split"] for r in sp.stable_split(df.repartition(7), "rid", 0.2, 0.1).collect()}
    assert c == d


def test_two_way_split_test_is_validation(spark):
    s = sp.stratified_split(data(spark), "rid", "y", 0.2, 0.0)
    assert s.where(F.col("split") == "test").count() == 0
    v = sorted(r["rid"] for r in sp.split_part(s, "validation", 0.0).collect())
    t = sorted(r["rid"] for r in sp.split_part(s, "test", 0.0).collect())
    assert v == t and len(v) == 400


@pytest.mark.parametrize("v,t", [(0, 0.1), (1, 0), (0.5, -0.1), (0.5, 1), (0.6, 0.4)])
def test_fraction_guard(v, t):
    with pytest.raises(ValueError):
        check_split_fractions(v, t)
