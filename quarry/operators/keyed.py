"""Key/time chunking shared by the per-key sequence operators.

A per-key window (``partitionBy(key)``) puts every row of one key in one task.
When one key holds a large share of the data that task dominates the job.  We
therefore split *hot* keys into time chunks: ``(key, _chunk)`` becomes the
window partition, each chunk is processed independently, and a small carry
table (one row per hot chunk) supplies the state of all earlier chunks.

* hot keys are those with more than ``hot_key_rows`` rows (one aggregate over
  the key and time columns, partial aggregation on the map side);
* the hot-key table has at most ``rows / hot_key_rows`` rows; it stays a table
  and Spark chooses how to join it;
* a hot key's rows are cut at quantiles of their time, so that a chunk holds
  about ``hot_key_rows`` rows however bursty they come; rows with the same
  timestamp always land in the same chunk, so ties keep their order.

A NULL key is a key like any other and is split like any other.  Non-hot keys
keep ``_chunk = 0`` and no carry is needed for them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import epoch_micros
from quarry.session import cut_lineage

HOT_KEY_CONF = "quarry.skew.hotKeyRows"
DEFAULT_HOT_KEY_ROWS = 2_000_000
CHUNK = "_chunk"
HOT = "_hot"


@dataclass(frozen=True)
class EventOrder:
    """Per-key event order: ``partitionBy(key).orderBy(ts, tie)``."""

    key: str
    ts: str
    tie: str


def hot_key_rows(spark: SparkSession, override: int | None = None) -> int:
    if override is not None:
        return int(override)
    return int(spark.conf.get(HOT_KEY_CONF, str(DEFAULT_HOT_KEY_ROWS)))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; right keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"__{k}" for k in keys])


def hot_key_chunks(df: DataFrame, order: EventOrder, threshold: int,
                   time_us: Column | None = None, name: str | None = None) -> DataFrame | None:
    """Table ``(key, _bounds)`` of the hot keys, or None if there are none.

    ``_bounds``: ascending times (microseconds) at which a chunk begins; the
    key's rows are counted first, then only hot rows are summarised.  With a
    ``name`` both steps end in a written table: each runs once, however often
    the plan uses it, and Spark knows its size when it plans a join.
    """
    kept = (lambda t: t) if name is None else (lambda t: cut_lineage(t, name))
    ts_us = epoch_micros(order.ts) if time_us is None else time_us
    sizes = kept(df.groupBy(order.key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.lit(threshold)))
    largest = sizes.agg(F.max("_n")).first()[0]
    if largest is None:
        return None
    rows = join_null_safe(df.select(order.key, ts_us.alias("_t")), sizes, [order.key], "inner")
    return kept(_quantile_cuts(rows, order.key, int(largest), threshold))


def _quantile_cuts(rows: DataFrame, key: str, largest: int, threshold: int) -> DataFrame:
    """``key, _bounds``: ascending values at which the rows ``(key, _t, _n)`` of a key are cut into pieces
    of about ``threshold`` rows; the pieces of the largest key bound the quantiles of every key."""
    parts = -(-largest // threshold)
    probs = [i / parts for i in range(1, parts)]
    cuts = rows.groupBy(key).agg(F.percentile_approx("_t", probs, max(10_000, 20 * parts)).alias("_q"),
                                 F.max("_n").alias("_n"))
    step = F.greatest(F.lit(1), F.floor(F.lit(largest) / F.col("_n"))).cast("int")
    kept = F.filter("_q", lambda x, i: (i + 1) % step == 0)
    return cuts.select(key, F.array_distinct(kept).alias("_bounds"))


def hot_row_cuts(rows: DataFrame, key: str, tile: str, offset: str, threshold: int) -> DataFrame | None:
    """Table ``(key, _bounds)`` of the keys with more than ``threshold`` rows in one tile, or None.

    ``_bounds`` cuts the key's offsets so that over all its tiles, and so in
    each of them, a piece holds about ``threshold`` rows.
    """
    sizes = rows.groupBy(key, tile).agg(F.count(F.lit(1)).alias("_n")).groupBy(key).agg(F.max("_n").alias("_top"), F.sum("_n").alias("_n"))
    sizes = sizes.where(F.col("_top") > F.lit(threshold)).drop("_top")
    largest = sizes.agg(F.max("_n")).first()[0]
    if largest is None:
        return None
    hot = join_null_safe(rows.select(key, F.col(offset).alias("_t")), sizes, [key], "inner")
    return _quantile_cuts(hot, key, int(largest), threshold)


def by_ranges(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``df`` as a written table with ``_r``: ranges of ``columns`` of about equal size that ascend with ``_r``.

    Spark samples the rows for the bounds and merges small ranges; the table is
    written because a later sample may set other bounds."""
    return cut_lineage(df.repartitionByRange(*columns).withColumn("_r", F.spark_partition_id()), name)


def position_in(bounds: str | Column, t: Column) -> Column:
    """Number of the ascending ``bounds`` at or before ``t``, by binary search; 0 without bounds."""
    at = F.col(bounds) if isinstance(bounds, str) else bounds
    n = F.size(at)
    # the answer's binary digits, highest first: one is set if the bound that it would pass is at or before t
    places = F.sequence(F.length(F.bin(n.cast("long"))) - 1, F.lit(0), F.lit(-1))
    digits = F.transform(places, lambda i: F.pow(F.lit(2), i).cast("int"))

    def step(found: Column, digit: Column) -> Column:
        more = found + digit
        return F.when((more <= n) & (F.get(at, more - 1) <= t), more).otherwise(found)

    return F.when(n > 0, F.aggregate(digits, F.lit(0), step)).otherwise(F.lit(0))


def chunk_of(t: Column) -> Column:
    """Chunk of a time: the number of ``_bounds`` at or before it."""
    return F.coalesce(position_in("_bounds", t), F.lit(0)).cast("long")


def with_chunks(df: DataFrame, order: EventOrder, hot: DataFrame | None,
                time_us: Column | None = None) -> DataFrame:
    """Add ``_chunk`` (0 for ordinary keys, a time-chunk index for hot keys).

    ``time_us`` (default: the order's timestamp) places each row; it must be
    monotone in the event order so that chunks are contiguous.
    """
    if hot is None:
        return df.withColumns({CHUNK: F.lit(0).cast("long"), HOT: F.lit(False)})
    t = epoch_micros(order.ts) if time_us is None else time_us
    joined = join_null_safe(df, hot, [order.key])
    chunk = F.when(F.col("_bounds").isNull() | t.isNull(), F.lit(0)).otherwise(chunk_of(t))
    return joined.withColumns({CHUNK: chunk.cast("long"), HOT: F.col("_bounds").isNotNull()}).drop("_bounds")
