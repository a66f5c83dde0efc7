"""Drift against a fitted baseline and verification of scored rows: edges that the keys do not hold."""

import math

from pyspark.sql import functions as F

from quarry.operators.drift import column_drift, fit_baseline
from quarry.operators.scoring import Provenance, score_rows
from quarry.operators.verify import verification_summary, verify_scored_rows
from quarry.sources.snapshots import SnapshotTable
from quarry.spec import FeatureSpec

SCHEMA = "x double, flag boolean, s string"


def test_same_rows_do_not_drift(spark):
    rows = [(float(i % 40), i % 3 == 0, None if i % 5 == 0 else f"c{i % 7}") for i in range(400)]
    df = spark.createDataFrame(rows + [(float("nan"), None, ""), (float("inf"), None, "missing"), (None, True, "nan")], SCHEMA)
    base = fit_baseline(df, ["x"], ["flag", "s"], bins=4)
    got = {r.column_name: r for r in column_drift(base, df.repartition(5)).collect()}
    assert set(got) == {"x", "flag", "s"}
    assert all(r.psi == 0 and not r.drift and r.n_base == r.n_cur == 403 for r in got.values())
    # marks of missing cells and of NaN are not mistaken for texts that read alike
    assert base.where("column_name = 's' and kind = 'value' and bin in ('missing', 'nan')").count() == 2


def test_planted_shift_by_hand(spark):
    base = fit_baseline(spark.createDataFrame([(float(i), True, "a") for i in range(100)], SCHEMA), ["x"], ["flag", "s"], bins=2)
    assert base.where("kind = 'edges'").first()["edges"] == [49.5]
    later = spark.createDataFrame([(float(i), True, "b" if i % 4 == 0 else "a") for i in range(40, 60)] + [(None, True, "a")] * 5, SCHEMA)
    got = {r.column_name: r.psi for r in column_drift(base, later).collect()}
    eps = 1e-6
    psi = lambda pairs: sum((max(q, eps) - max(p, eps)) * math.log(max(q, eps) / max(p, eps)) for p, q in pairs)
    assert abs(got["x"] - psi([(.5, .4), (.5, .4), (0, .2)])) < 1e-9
    assert abs(got["s"] - psi([(1, .8), (0, .2)])) < 1e-9
    assert got["flag"] == 0


def test_empty_sides_and_column_without_numbers(spark):
    df = spark.createDataFrame([(None, None, None), (None, None, "a")], SCHEMA)
    base = fit_baseline(df, ["x"], ["s"])
    assert {(r.column_name, r.psi) for r in column_drift(base, df).collect()} == {("x", 0.0), ("s", 0.0)}
    none = column_drift(base, df.limit(0)).collect()
    assert {(r.column_name, r.n_cur, r.psi, r.drift) for r in none} == {("x", 0, None, False), ("s", 0, None, False)}


def test_verdicts(spark, tmp_dir):
    spec = FeatureSpec(metadata=("id",), numeric=("x",), boolean=("flag",), categorical=("s",))
    table = SnapshotTable(spark, f"{tmp_dir}/t")
    rows = [(None, 1.0, True, "a"), (1, 0.1 + 0.2, None, "a|b"), (1, 2.0, False, ""), (2, None, None, None)]
    table.publish(spark.createDataFrame(rows, f"id int, {SCHEMA}"))
    table.publish(spark.createDataFrame([(2, 0.0, None, None), (1, 2.0, False, "")], f"id int, {SCHEMA}"))
    prov = Provenance("m", "champion", "1", "run", "t", 0, None)
    scored = score_rows(table.read(0), spec, lambda df: df.withColumn("score", F.lit(0.5)), prov)
    first = verify_scored_rows(scored, table, spec)
    assert [(r.verdict, r.n_rows) for r in verification_summary(first).collect()] == [("ok", 4)]  # also NULL and repeated ids
    second = verify_scored_rows(scored.withColumn("feature_table_version", F.lit("1")), table, spec)
    # of the two predictions of id 1 one is reproduced; NULL against 0.0 is a change; the NULL id is gone
    assert sorted((r.id or 0, r.verdict) for r in second.collect()) == [(0, "no_row"), (1, "changed"), (1, "ok"), (2, "changed")]
    unknown = verify_scored_rows(scored.withColumn("feature_table_version", F.lit("x")), table, spec)
    assert unknown.where("verdict = 'no_version'").count() == 4
    assert verify_scored_rows(scored.limit(0), table, spec).count() == 0
