"""Bounded samples: the same rows whatever the partitioning, limited before the shuffle."""

from pyspark.sql import functions as F

from quarry.operators.dataset import sample_rows


def test_sample_rows(spark):
    df = spark.range(500).select(F.col("id"), F.when(F.col("id") % 3 > 0, F.lit(None)).otherwise(F.col("id") % 2).alias("g"))
    got = [sorted((r.id, str(r.g)) for r in sample_rows(df.repartition(n), "id", 4, 7, ("g",)).collect()) for n in (1, 7)]
    assert got[0] == got[1] and len(got[0]) == 12
    assert sample_rows(df, "id", 4).count() == 4 and sample_rows(df.limit(0), "id", 4).count() == 0
    plan = sample_rows(df, "id", 4, 7, ("g",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # in every task, then in all
