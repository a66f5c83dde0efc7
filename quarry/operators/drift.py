"""Drift of all columns against a fitted baseline.

A baseline is a table: for each numeric column the bins between its exact
equal-frequency edges, for each other column every value, and the rows of the
baseline in each.  It is fitted once, kept next to the snapshot that it
describes, and later rows are counted into the same bins; the statistic is the
population stability index (our choice, as in ``monitor.psi``).

Cells are counted per (column, bin) with partial aggregation.  Only the edges
(columns x bins) reach the driver; categories stay a table and are joined, so
their number has no bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.keyed import position_in
from quarry.operators.monitor import DRIFT_THRESHOLD, PSI_EPS
from quarry.operators.prep import column_quantiles

BINS = 10
MISSING, NOT_A_NUMBER = "missing", "nan"


def _cells(df: DataFrame, edges: dict[str, list[float]], categorical: list[str]) -> DataFrame:
    """``column_name, kind, bin``: kind ``number`` with the bin's index, ``value`` with the value as text, or
    one of the marks without a bin."""
    def cell(c: str, kind: Column, b: Column) -> Column:
        return F.struct(F.lit(c).alias("column_name"), kind.alias("kind"), b.cast("string").alias("bin"))

    cells = []
    for c, at in edges.items():
        x = F.col(c).cast("double")
        kind = F.when(x.isNull(), MISSING).when(F.isnan(x), NOT_A_NUMBER).otherwise("number")
        bounds = F.array(*[F.lit(float(e)) for e in at]).cast("array<double>")
        cells.append(cell(c, kind, F.when(kind == "number", position_in(bounds, x))))
    for c in categorical:
        cells.append(cell(c, F.when(F.col(c).isNull(), MISSING).otherwise("value"), F.col(c)))
    return df.select(F.explode(F.array(*cells)).alias("_e")).select("_e.*")


def _counted(df: DataFrame, edges: dict[str, list[float]], categorical: list[str], name: str) -> DataFrame:
    return _cells(df, edges, categorical).groupBy("column_name", "kind", "bin").agg(F.count(F.lit(1)).alias(name))


def fit_baseline(df: DataFrame, numeric: list[str], categorical: list[str], bins: int = BINS) -> DataFrame:
    """Baseline table ``column_name, kind, bin, n, edges``.

    Bin i of a numeric column holds the values from edge i - 1 up to, not
    including, edge i; edges are the distinct exact quantiles at i / bins, and
    the outer bins are open.  ``edges`` stands on a row of kind ``edges`` for
    each numeric column.  A column without numbers has no edges and one bin."""
    probs = [i / bins for i in range(1, bins)]
    found = column_quantiles(df, list(numeric), probs) if numeric else {}
    edges = {c: sorted({found[c][p] for p in probs} - {None}) for c in numeric}
    spark = df.sparkSession
    kept = spark.createDataFrame([(c, "edges", e) for c, e in edges.items()], "column_name string, kind string, edges array<double>")
    return _counted(df, edges, list(categorical), "n").unionByName(kept, allowMissingColumns=True)


def column_drift(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """``column_name, n_base, n_cur, psi, drift`` for every column of a ``fit_baseline`` table.

    Shares are of a column's rows, at least ``PSI_EPS``; NULL and NaN are bins
    of their own, and a value that the baseline lacks is a bin with no share
    in it.  A side without rows gives a NULL ``psi`` and no drift."""
    kept = {r["column_name"]: list(r["edges"]) for r in baseline.where("kind = 'edges'").select("column_name", "edges").collect()}
    names = [r["column_name"] for r in baseline.where("kind <> 'edges'").select("column_name").distinct().collect()]
    base = baseline.where("kind <> 'edges'").select("column_name", "kind", F.coalesce("bin", F.lit("")).alias("bin"), "n")
    seen = _counted(current, kept, [c for c in names if c not in kept], "m").withColumn("bin", F.coalesce("bin", F.lit("")))
    pairs = base.join(seen, ["column_name", "kind", "bin"], "full").fillna(0, ["n", "m"])
    sums = pairs.groupBy("column_name").agg(F.sum("n").alias("n_base"), F.sum("m").alias("n_cur"))
    p, q = (F.greatest(F.try_divide(F.col(a), F.col(b)), F.lit(PSI_EPS)) for a, b in (("n", "n_base"), ("m", "n_cur")))
    both = (F.col("n_base") > 0) & (F.col("n_cur") > 0)
    return (pairs.join(sums, "column_name").groupBy("column_name", "n_base", "n_cur")
            .agg(F.sum(F.when(both, (q - p) * F.log(q / p))).alias("psi"))
            .withColumn("drift", F.coalesce(F.col("psi") > DRIFT_THRESHOLD, F.lit(False))))
