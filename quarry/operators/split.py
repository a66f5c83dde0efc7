"""Seeded train / validation / test splits.

*stable*: each row's split follows from a hash of ``seed:id`` alone: no
shuffle, and the same id lands in the same split in every snapshot.

*exact* (stratified): per class with ``n`` rows, rows are ordered by
``(hash, id)`` and the first ``floor(n·f_train + 0.5)`` go to train, up to
``floor(n·(f_train + f_val) + 0.5)`` to validation, the rest to test.  The cut
rows are found without ranking a whole class in one task: a histogram of the
top 16 hash bits per class (partial aggregate), then of the next 16 bits in
the selected bucket, and only the rows of the final bucket (~n / 2^32) are
ranked.  With ``test_fraction == 0`` there are two parts and ``test`` is the
validation set (flagged by ``test_is_validation``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.digest import hash_prefix_60
from quarry.session import cut_lineage
from quarry.spec import check_split_fractions

SPLIT = "split"


def _hash60(id_col: str, seed: int):
    return hash_prefix_60(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))).cast("long")


def stable_split(df: DataFrame, id_col: str, validation_fraction: float, test_fraction: float,
                 seed: int = 42) -> DataFrame:
    check_split_fractions(validation_fraction, test_fraction)
    u = _hash60(id_col, seed).cast("double") / F.lit(float(1 << 60))
    train_f = 1.0 - validation_fraction - test_fraction
    split = (F.when(u < F.lit(train_f), F.lit("train"))
              .when(u < F.lit(train_f + validation_fraction), F.lit("validation"))
              .otherwise(F.lit("test")))
    return df.withColumn(SPLIT, split)


def _hist1(keys: DataFrame, target: str) -> DataFrame:
    return keys.groupBy(target, F.shiftright("_h", 44).alias("_b1")).agg(F.count(F.lit(1)).alias("_c"))


def _select_cuts(keys: DataFrame, target: str, quotas: DataFrame, qcols: list[str],
                 hist1: DataFrame | None = None) -> DataFrame:
    """Per class and quota column, the (hash, id) of the row whose 1-based
    rank in (hash, id) order equals the quota (no row when the quota is 0).

    Three passes over the narrow keys regardless of the number of cuts: a
    16-bit histogram per class (partial aggregate), a second 16-bit histogram
    over the rows of the selected buckets only, and a ranking of the few rows
    (~n / 2^32 per cut) of the final buckets.  Every intermediate table has
    at most classes × cuts × 65536 rows.
    """
    b1 = F.shiftright("_h", 44)
    b2 = F.shiftright("_h", 28).bitwiseAND(F.lit(0xFFFF))
    q = quotas.select(target, F.explode(F.array(*[
        F.struct(F.lit(c).alias("cut"), F.col(c).alias("q")) for c in qcols])).alias("_q")).select(
        target, "_q.cut", "_q.q").where(F.col("q") > 0)
    hist1 = _hist1(keys, target) if hist1 is None else hist1
    w1 = Window.partitionBy(target).orderBy("_b1").rowsBetween(Window.unboundedPreceding, 0)
    pick1 = (hist1.withColumn("_cum", F.sum("_c").over(w1)).join(F.broadcast(q), target)
                  .where((F.col("_cum") >= F.col("q")) & (F.col("_cum") - F.col("_c") < F.col("q")))
                  .select(target, "cut", "_b1", (F.col("q") - (F.col("_cum") - F.col("_c"))).alias("_r1")))
    in1 = keys.withColumn("_b1", b1).join(F.broadcast(pick1), [target, "_b1"])
    hist2 = in1.groupBy(target, "cut", "_r1", "_b1", b2.alias("_b2")).agg(F.count(F.lit(1)).alias("_c"))
    w2 = Window.partitionBy(target, "cut").orderBy("_b2").rowsBetween(Window.unboundedPreceding, 0)
    pick2 = (hist2.withColumn("_cum", F.sum("_c").over(w2))
                  .where((F.col("_cum") >= F.col("_r1")) & (F.col("_cum") - F.col("_c") < F.col("_r1")))
                  .select(target, "cut", "_b1", "_b2", (F.col("_r1") - (F.col("_cum") - F.col("_c"))).alias("_r2")))
    in2 = keys.withColumns({"_b1": b1, "_b2": b2}).join(F.broadcast(pick2), [target, "_b1", "_b2"])
    w3 = Window.partitionBy(target, "cut").orderBy("_h", "_id")
    found = (in2.withColumn("_rk", F.row_number().over(w3)).where(F.col("_rk") == F.col("_r2"))
                .select(target, "cut", F.struct("_h", "_id").alias("_at")))
    return found.groupBy(target).pivot("cut", qcols).agg(F.first("_at"))


def stratified_split(df: DataFrame, id_col: str, target: str, validation_fraction: float,
                     test_fraction: float, seed: int = 42) -> DataFrame:
    """Exact stratified split; adds ``split`` (train / validation / test).

    The unit is the id: quotas count a class's distinct ids, and rows that
    repeat an id within a class go to the same part."""
    check_split_fractions(validation_fraction, test_fraction)
    train_f = 1.0 - validation_fraction - test_fraction
    hashed = df.withColumns({"_h": _hash60(id_col, seed), "_id": F.col(id_col)})
    keys = cut_lineage(hashed.select(target, "_h", "_id").distinct(), "split-keys")  # read four times below
    hist1 = _hist1(keys, target)
    # class sizes from the level-1 histogram: no separate counting pass
    counts = hist1.groupBy(target).agg(F.sum("_c").alias("_n"))
    quotas = counts.select(
        target, "_n",
        F.floor(F.col("_n") * F.lit(train_f) + F.lit(0.5)).alias("_q_train"),
        F.floor(F.col("_n") * F.lit(1.0 - test_fraction) + F.lit(0.5)).alias("_q_val"))
    cuts = _select_cuts(keys, target, quotas.drop("_n"), ["_q_train", "_q_val"], hist1)
    me = F.struct("_h", "_id")
    split = (F.when(F.col("_q_train").isNotNull() & (me <= F.col("_q_train")), F.lit("train"))
              .when(F.col("_q_val").isNotNull() & (me <= F.col("_q_val")), F.lit("validation"))
              .otherwise(F.lit("test")))
    # cuts: one row per class — bounded, broadcast.
    return (hashed.join(F.broadcast(cuts), target, "left")
                  .withColumn(SPLIT, split)
                  .drop("_h", "_id", "_q_train", "_q_val"))


def split_part(split_df: DataFrame, name: str, test_fraction: float) -> DataFrame:
    """One part of a split; with ``test_fraction == 0`` ``test`` is the
    validation part (the reference's two-way mode)."""
    if name == "test" and test_fraction == 0:
        name = "validation"
    return split_df.where(F.col(SPLIT) == name)


def split_counts(split_df: DataFrame, target: str | None = None) -> DataFrame:
    keys = [SPLIT] + ([target] if target else [])
    return split_df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
