"""Point-in-time (as-of) join: each left row gets the latest right row of the
same key whose time is at or before the left row's time.

Both sides are unioned into one stream ordered by ``(time, side, tie)``; a
running ``last(payload, ignorenulls)`` over ``partitionBy(key, _chunk)`` picks
the latest right payload for every left row.  One shuffle, no pair blow-up,
no per-key candidate cap.  Hot keys are split into time chunks (see
``keyed``) and continue from the last right payload of the earlier chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalar import epoch_micros
from quarry.operators.keyed import CHUNK, HOT, EventOrder, hot_key_chunks, hot_key_rows, with_chunks


def asof_join(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str,
              left_time: str, right_time: str, right_tie: str, payload: list[str],
              inclusive: bool = True, prefix: str = "", hot_threshold: int | None = None) -> DataFrame:
    """Left rows plus ``prefix + payload`` columns (NULL when nothing matches).

    ``inclusive``: right time ``<=`` left time (else ``<``).  Among right rows
    with equal time the largest ``right_tie`` wins.  A NULL key matches
    nothing, a right row without a time is never known, and a left row without
    a time knows nothing.
    """
    spark = left.sparkSession
    left_cols = left.columns
    l_side, r_side = (1, 0) if inclusive else (0, 1)
    pay = F.struct(*[F.col(c).alias(prefix + c) for c in payload])
    placed = F.col(left_key).isNotNull() & F.col(left_time).isNotNull()
    L = left.where(placed).withColumns({"_k": F.col(left_key), "_time": epoch_micros(left_time),
                          "_side": F.lit(l_side), "_tie": F.lit(None).cast(right.schema[right_tie].dataType)})
    R = right.where(F.col(right_key).isNotNull() & F.col(right_time).isNotNull()).select(F.col(right_key).alias("_k"), epoch_micros(right_time).alias("_time"),
                     F.lit(r_side).alias("_side"), F.col(right_tie).alias("_tie"), pay.alias("_pay"))
    stream = L.unionByName(R, allowMissingColumns=True)
    order = EventOrder("_k", "_time", "_tie")
    hot = hot_key_chunks(stream, order, hot_key_rows(spark, hot_threshold), time_us=F.col("_time"))
    stream = with_chunks(stream, order, hot, time_us=F.col("_time"))
    w = (Window.partitionBy("_k", CHUNK).orderBy("_time", "_side", "_tie")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = stream.withColumn("_m", F.last("_pay", ignorenulls=True).over(w)).where(F.col("_side") == l_side)
    if hot is not None:
        # every hot chunk gets a row (also chunks holding only left rows),
        # so each one can receive the carry of the chunks before it
        has = F.col("_pay").isNotNull()
        summary = (stream.where(F.col(HOT))
                         .groupBy("_k", CHUNK)
                         .agg(F.max_by(F.when(has, F.col("_pay")),
                                       F.when(has, F.struct("_time", "_tie"))).alias("_lp")))
        before = Window.partitionBy("_k").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carry = summary.select("_k", CHUNK, F.last("_lp", ignorenulls=True).over(before).alias("_cp"))
        out = (out.join(carry, ["_k", CHUNK], "left")
                  .withColumn("_m", F.coalesce("_m", "_cp")))
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(prefix + c) for c in payload]
    return out.select(*left_cols, *[F.col(f"_m.{prefix}{c}").alias(prefix + c) for c in payload]).unionByName(
        left.where(~placed).select(*left_cols, *nothing))
