"""Sum of a key's last k values with k per row, without lists of k values.

Up to ``SHORT`` rows are added from the lags of the features' own window.  For
rows that ask for more, a key's rows are numbered and lie in blocks of
``SHORT``: a frame is the beginning of the row's own block, which the lags
hold, whole blocks, and the end of the block that it starts in.  Whole blocks
are the leaves of a binary tree of sums, of which a frame takes at most two
nodes a level, so a row with k = 10^6 looks up some thirty nodes and not 10^6
values.  Sums are made of the frame's own values alone; nothing is subtracted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.keyed import join_null_safe
from quarry.session import cut_lineage

#: Rows that the lags reach; also the rows of a block (a power of two).
SHORT = 16


def lags(value: Column, window) -> dict[str, Column]:
    return {f"_lag{m}": F.lag(value.cast("double"), m).over(window) for m in range(1, SHORT)}


def recent(value: Column, rows_here: Column, earlier: Column | None) -> list[Column]:
    """The last ``SHORT`` values, latest first; those before the chunk from ``earlier`` (latest first)."""
    here = [value.cast("double"), *[F.col(f"_lag{m}") for m in range(1, SHORT)]]
    if earlier is None:
        return here
    return [here[0], *[F.when(rows_here > m, c).otherwise(F.get(earlier, (F.lit(m) - rows_here).cast("int"))) for m, c in enumerate(here) if m]]


def direct_sum(values: list[Column], k: Column) -> Column:
    """Sum of the first ``k`` of the values (at most all of them), NULL as 0."""
    total = F.coalesce(values[0], F.lit(0.0))
    for m, c in enumerate(values[1:], 1):
        total = total + F.when(k > m, F.coalesce(c, F.lit(0.0))).otherwise(F.lit(0.0))
    return total


def has_long(df: DataFrame, k_col: str) -> bool:
    """Whether any row asks for more than the lags reach (the scan ends at the first)."""
    return not df.where(F.col(k_col) > SHORT).select(F.lit(1)).isEmpty()


def add_long(df: DataFrame, key: str, number: str, value: str, k: Column, own: Column, out: str) -> DataFrame:
    """``df`` with ``out`` for the rows whose ``k`` exceeds ``SHORT``: ``own`` (the part in the row's block) and what lies before.

    ``number`` is the row's number in its key, from 1; with the key it names the row.
    """
    b = F.lit(SHORT)
    df = cut_lineage(df.withColumns({"_long": k > SHORT, "_first": F.greatest(F.col(number) - k, F.lit(0)).cast("long"),
                                     "_block": F.call_function("div", F.col(number) - 1, b)}), "lastk")
    blocks = (df.groupBy(key, "_block").agg(F.sort_array(F.collect_list(F.struct(F.col(number).alias("_i"), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("_v")))).alias("_vs"))
              .withColumn("_vs", F.col("_vs._v")))  # at most SHORT values
    blocks = cut_lineage(blocks, "blocks")
    top = blocks.agg(F.max("_block")).first()[0] or 0
    levels = F.sequence(F.lit(0), F.lit(max(0, int(top).bit_length() - 1)))

    def power(level: Column) -> Column:
        return F.pow(F.lit(2), level).cast("long")

    whole = F.aggregate("_vs", F.lit(0.0), lambda a, x: a + x)
    nodes = (blocks.select(key, "_block", whole.alias("_s"), F.explode(levels).alias("_level"))
             .groupBy(key, "_level", F.call_function("div", F.col("_block"), power(F.col("_level"))).alias("_node")).agg(F.sum("_s").alias("_s")))
    # the block that a frame starts in, and the blocks [after it, own) as nodes: at each level the
    # last of an odd left end and the last before an odd right end
    asks = (df.where("_long").select(key, number, "_first", F.call_function("div", F.col("_first"), b).alias("_from"), F.col("_block").alias("_own"))
            .where(F.col("_from") < F.col("_own")))
    start = (join_null_safe(asks.select(key, number, F.col("_from").alias("_block"), (F.col("_first") % b + 1).cast("int").alias("_at")), blocks,
                            [key, "_block"], "inner")
             .select(key, number, F.aggregate(F.slice("_vs", F.col("_at"), b), F.lit(0.0), lambda a, x: a + x).alias("_s")))
    step = asks.select(key, number, (F.col("_from") + 1).alias("_a"), F.col("_own").alias("_b"), F.explode(levels).alias("_level"))
    p = power(F.col("_level"))
    step = step.select(key, number, "_level", F.call_function("div", F.col("_a") + p - 1, p).alias("_l"), F.call_function("div", F.col("_b"), p).alias("_r"))
    step = step.where(F.col("_l") < F.col("_r")).select(key, number, "_level", F.explode(F.filter(F.array(
        F.when(F.col("_l") % 2 == 1, F.col("_l")), F.when(F.col("_r") % 2 == 1, F.col("_r") - 1)), lambda x: x.isNotNull())).alias("_node"))
    middle = join_null_safe(step, nodes, [key, "_level", "_node"], "inner").select(key, number, "_s")
    before = start.unionByName(middle).groupBy(key, number).agg(F.sum("_s").alias("_before"))
    joined = join_null_safe(df, before, [key, number])
    return joined.withColumn(out, F.when(F.col("_long"), own + F.coalesce("_before", F.lit(0.0))).otherwise(F.col(out)))
