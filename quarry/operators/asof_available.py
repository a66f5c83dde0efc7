"""As-of join on two time axes: each left row gets the latest right row of its
key that happened at or before the row's time and was available by the row's
own cutoff (J1 for labels that arrive late).

The two conditions do not order one another, so a running window over one axis
cannot answer both.  Right rows are ranked by their time within the key and cut
into leaves of ``LEAF`` ranks.  A left row first looks through the ranks before
it in its own leaf, a bounded list; as these are the latest ones, an answer
found there is final and brings its payload along.  Only left rows without one
ask the leaves before their own, and only right rows of keys with such leaves
are copied: the ``p`` leaves are cut into one block for each binary digit 1 of
``p``, and a right row belongs to one block for each digit 0 of its leaf.
Within a block the time condition holds for every pair, so one sweep by
availability (a running maximum of ranks) answers it; a left row takes the best
of its blocks.  Rows grow by at most the number of digits of a key's leaves (on
average half of that), whatever the number of pairs that match; in the blocks
only ranks and times are copied, payloads join at the end.

Hot keys are ranked in time chunks, each of which begins a leaf, and their
blocks swept in chunks of availability (see ``keyed``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalar import epoch_micros
from quarry.operators.keyed import CHUNK, HOT, EventOrder, hot_key_chunks, hot_key_rows, join_null_safe, with_chunks
from quarry.session import cut_lineage

LEFT, RIGHT = 1, 0
#: Ranks of a leaf: the right rows that a left row looks through one by one; a power of two.
LEAF = 32


def asof_available_join(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str,
                        left_time: str, left_cutoff: str, right_time: str, right_available: str,
                        right_tie: str, payload: list[str], prefix: str = "",
                        hot_threshold: int | None = None) -> DataFrame:
    """Left rows plus ``prefix + payload`` columns (NULL when nothing matches).

    A right row matches if its key is equal, ``right_time <= left_time`` and
    ``right_available <= left_cutoff``; the latest time wins, then the largest
    ``right_tie`` (rows equal in both should not differ in payload).  A right
    row without a time or an availability is never known; a left row without a
    key, a time or a cutoff knows nothing.
    """
    threshold = hot_key_rows(left.sparkSession, hot_threshold)
    placed = F.col(left_key).isNotNull() & F.col(left_time).isNotNull() & F.col(left_cutoff).isNotNull()
    known = F.col(right_key).isNotNull() & F.col(right_time).isNotNull() & F.col(right_available).isNotNull()
    asked = left.where(placed).withColumns({
        "_k": F.col(left_key), "_time": epoch_micros(left_time), "_at": epoch_micros(left_cutoff), "_side": F.lit(LEFT),
        "_tie": F.lit(None).cast(right.schema[right_tie].dataType)})
    pay = F.struct(*[F.col(c).alias(prefix + c) for c in payload])
    given = right.where(known).select(
        F.col(right_key).alias("_k"), epoch_micros(right_time).alias("_time"), epoch_micros(right_available).alias("_at"),
        F.lit(RIGHT).alias("_side"), F.col(right_tie).alias("_tie"), pay.alias("_pay"))
    near, hot = _own_leaf(asked.unionByName(given, allowMissingColumns=True), threshold)
    placed_rows = _placed(near)
    best = _latest_available(placed_rows, threshold if hot else None)
    found = best.join(placed_rows.where(F.col("_side") == RIGHT).select("_k", "_r", "_pay"), ["_k", "_r"]).drop("_r")
    far = placed_rows.where(F.col("_side") == LEFT).drop("_pay").join(found, ["_k", "_leaf", "_at"], "left")
    out = near.where((F.col("_side") == LEFT) & ~F.col("_open")).select(*left.columns, "_pay").unionByName(far.select(*left.columns, "_pay"))
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(prefix + c) for c in payload]
    return out.select(*left.columns, *[F.col(f"_pay.{prefix}{c}").alias(prefix + c) for c in payload]).unionByName(
        left.where(~F.coalesce(placed, F.lit(False))).select(*left.columns, *nothing))


def _own_leaf(stream: DataFrame, threshold: int) -> tuple[DataFrame, bool]:
    """``stream`` as a written table with the ``_leaf`` of each row, numbered within its chunk, and ``_n``, the
    number of right rows of the chunk up to the row (from 1 for right rows); whether there are hot keys.

    A left row's ``_pay`` is its answer from its own leaf; ``_open``: it has none there, but there may be leaves
    before.  Right rows of a leaf that no other leaf can follow are left out."""
    order = EventOrder("_k", "_time", "_tie")
    hot = hot_key_chunks(stream, order, threshold, time_us=F.col("_time"), name="asof-hot")
    stream = with_chunks(stream, order, hot, time_us=F.col("_time"))
    is_right = F.col("_side") == RIGHT
    upto = (Window.partitionBy("_k", CHUNK).orderBy("_time", "_side", "_tie", "_at")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    leaf = (Window.partitionBy("_k", CHUNK, "_leaf").orderBy("_n")
            .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    held = F.collect_list(F.when(is_right, F.struct("_n", "_at", "_pay")))
    known = F.filter("_held", lambda x: (x["_n"] <= F.col("_n")) & (x["_at"] <= F.col("_at")))
    out = (stream.withColumn("_n", F.sum(is_right.cast("long")).over(upto))
           .withColumn("_leaf", F.floor((F.greatest(F.col("_n"), F.lit(1)) - 1) / LEAF))
           .withColumn("_held", held.over(leaf))
           .where(~is_right | F.col(HOT) | (F.size("_held") == LEAF))
           .withColumn("_pay", F.when(is_right, F.col("_pay")).otherwise(F.try_element_at(known, F.lit(-1))["_pay"]))
           .withColumn("_open", ~is_right & F.col("_pay").isNull() & (F.col(HOT) | (F.col("_leaf") > 0))))
    return cut_lineage(out.drop("_time", "_tie", "_held"), "asof-leaves"), hot is not None


def _placed(near: DataFrame) -> DataFrame:
    """Right rows and open left rows of ``near`` as a written table in which ``_leaf`` counts from the key's
    beginning: with ``_all``, the number of the key's leaves (those left out apart), and ``_r``, the rank."""
    rows = near.where((F.col("_side") == RIGHT) | F.col("_open"))
    leaves = F.max(F.when(F.col("_side") == RIGHT, F.col("_leaf") + 1))
    key = Window.partitionBy("_k")
    before = key.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_k", CHUNK).agg(F.coalesce(leaves, F.lit(0)).alias("_s"))
    carry = sizes.select("_k", CHUNK, F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"), F.sum("_s").over(key).alias("_all"))
    out = (rows.join(carry, ["_k", CHUNK]).withColumn("_leaf", F.col("_leaf") + F.col("_before"))
           .withColumn("_r", F.when(F.col("_side") == RIGHT, F.col("_leaf") * LEAF + (F.col("_n") - 1) % LEAF)))
    return cut_lineage(out.drop(CHUNK, "_before", "_n", "_open"), "asof-placed")


def _blocks(place: Column, size: Column, digit: int) -> Column:
    """(level, block) of ``place`` at each binary digit of ``size`` at which it has ``digit``."""
    levels = F.sequence(F.lit(0), F.length(F.bin(size)) - 1)
    return F.transform(F.filter(levels, lambda i: F.getbit(place, i) == digit),
                       lambda i: F.struct(i.alias("level"), F.call_function("shiftright", place, i + 1).alias("block")))


def _latest_available(placed: DataFrame, threshold: int | None) -> DataFrame:
    """``_k, _leaf, _at, _r``: for each distinct question (leaf, cutoff) with an answer, the greatest rank of a
    right row in an earlier leaf that was available; ``threshold`` is given where there are hot keys."""
    asked = placed.where((F.col("_side") == LEFT) & (F.col("_leaf") > 0)).select("_k", "_leaf", "_at", HOT).distinct()
    given = placed.where(F.col("_side") == RIGHT)
    asked = asked.withColumns({"_side": F.lit(LEFT), "_r": F.lit(None).cast("long"), "_b": F.explode(_blocks(F.col("_leaf"), F.col("_leaf"), 1))})
    given = given.select("_k", "_at", HOT, "_side", "_r", F.explode(_blocks(F.col("_leaf"), F.col("_all"), 0)).alias("_b"))
    parts = (asked.unionByName(given, allowMissingColumns=True)
             .withColumn("_g", F.struct("_k", "_b.level", "_b.block")).drop("_b"))
    order = EventOrder("_g", "_at", "_side")
    hot = None
    if threshold is not None:  # a block holds only rows of its key
        parts = cut_lineage(parts, "asof-blocks")
        hot = hot_key_chunks(parts.where(F.col(HOT)), order, threshold, time_us=F.col("_at"), name="asof-hot-blocks")
    parts = with_chunks(parts.drop(HOT), order, hot, time_us=F.col("_at"))
    upto = Window.partitionBy("_g", CHUNK).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = parts.withColumn("_best", F.max("_r").over(upto)).where(F.col("_side") == LEFT)
    if hot is not None:
        tops = parts.where(F.col(HOT)).groupBy("_g", CHUNK).agg(F.max("_r").alias("_top"))
        before = Window.partitionBy("_g").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carry = tops.select("_g", CHUNK, F.max("_top").over(before).alias("_earlier"))
        swept = join_null_safe(swept, carry, ["_g", CHUNK]).withColumn("_best", F.greatest("_best", "_earlier"))
    return swept.groupBy("_k", "_leaf", "_at").agg(F.max("_best").alias("_r")).where(F.col("_r").isNotNull())
