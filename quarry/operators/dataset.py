"""Training / scoring row sets over a feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.digest import hash_prefix_60
from quarry.spec import FeatureSpec, require_columns


def labeled_rows(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Rows with a label, ordered projection meta + features + target, target
    as int.  Lazy: the null filter and the projection reach the scan."""
    require_columns(df, spec.training_columns, "labeled_rows")
    return (df.where(F.col(spec.target).isNotNull())
              .select(*spec.metadata, *spec.features, F.col(spec.target).cast("int").alias(spec.target)))


def unlabeled_rows(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    require_columns(df, spec.scoring_columns, "unlabeled_rows")
    return df.where(F.col(spec.target).isNull()).select(*spec.scoring_columns)


def require_rows(df: DataFrame, context: str) -> None:
    """Empty-input guard (one-row probe job)."""
    if df.isEmpty():
        raise RuntimeError(f"{context}: no rows")


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Rows per class (partial aggregation; at most a few groups)."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n_rows"))


def require_two_classes(df: DataFrame, target: str) -> None:
    n = df.agg(F.count_distinct(target).alias("k")).first()["k"]
    if n < 2:
        raise RuntimeError("training needs both positive and negative examples")


def uniform_hash(id_col: str | Column, seed: int, method: str = "md5") -> Column:
    """Deterministic uniform in [0, 1) from ``seed:id``; independent of
    partitioning.  ``md5`` is reproducible by other engines; ``xxhash64`` is
    cheaper."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    if method == "xxhash64":
        return F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    h = F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))
    return hash_prefix_60(h).cast("double") / F.lit(float(1 << 60))


def assign_labels(df: DataFrame, id_col: str, seed: int = 42, out: str = "label",
                  p_true: float = 0.45, p_false: float = 0.45, method: str = "md5") -> DataFrame:
    """Seeded three-way label: u < p_true → True, u < p_true+p_false → False,
    else NULL (no label yet)."""
    u = uniform_hash(id_col, seed, method)
    lab = (F.when(u < F.lit(p_true), F.lit(True))
            .when(u < F.lit(p_true + p_false), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))
    return df.withColumn(out, lab)


def new_labels(current: DataFrame, previous: DataFrame, id_cols: list[str]) -> DataFrame:
    """Labelled rows of ``current`` whose id is absent from ``previous``
    (left anti join; AQE broadcasts the previous side only if it is small)."""
    return current.join(previous.select(*id_cols), id_cols, "left_anti")


def sample_rows(df: DataFrame, id_col: str, n: int, seed: int = 42, group_by: tuple[str, ...] = ()) -> DataFrame:
    """At most ``n`` rows of each group (NULL is one), those of the least hash of seed and id; ties by id.

    The choice depends on the rows alone, not on their partitioning.  Spark
    keeps the best ``n`` of a group in every task before the shuffle, so a hot
    group costs tasks x n rows.
    """
    order = [F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), F.col(id_col)]
    w = Window.partitionBy(*(group_by or (F.lit(0),))).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")
