"""Exact quantiles of each row's earlier values per key (W11), at scale.

Spark's ``percentile`` over ``rowsBetween(unboundedPreceding, -1)`` keeps
every earlier value and re-sorts the frame for every row: O(n²) per key,
and a hot key is one task.  This module computes the same numbers as order
statistics answered by a radix descent over value ranks:

1. every non-null value gets its place ``_rho`` among its key's values
   (``key_value_rank``: a window per key; a hot key is cut at quantiles of its
   values and the sizes of the lower pieces are added);
2. for a row with ``n`` earlier non-null values the wanted ranks are
   ``floor(h)`` and ``ceil(h)``, ``h = q·(n − 1)``; each is a *query row*
   that follows the row's own position in event order;
3. ranks are read in digits of 4–6 bits (``digit_plan``), most significant
   first.  At each level the data rows (prefix, digit of their rank) and the
   query rows (prefix found so far, remaining rank) are unioned, and one
   window over ``(key, _chunk, prefix)`` ordered by ``(ts, tie, kind)``
   counts, for each digit ``d``, the earlier data rows with digit ``<= d``.
   Ranks are those of a key, so the longest history sets the levels, not the
   number of values in the table.
   The query takes the first digit whose count passes its remaining rank.
   A query row follows both ranks while they share a prefix and splits in two
   only when they part, so there is about one query row per event.  On the
   last level the prefix is the answer's rank and the window also carries
   each digit's value, so no join by value or rank is needed.

Work is O(n · levels) rows per level with no frame re-aggregation and no cap
on history.  Hot keys use the time chunks of ``keyed``: the count of earlier
chunks with the same prefix comes from a carry table built from per-chunk
digit counts (partial aggregates) with a window over ``(key, prefix)``
ordered by chunk, whose rows are bounded by the number of hot chunks times
the prefixes their queries use.  With hot keys the query state is read twice
per level, so it is cut to the shared checkpoint folder after every level;
otherwise all levels chain in one plan.  Cuts are Parquet tables in the
shared checkpoint folder (``session.cut_lineage``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.keyed import CHUNK, HOT, EventOrder, hot_key_chunks, hot_key_rows, join_null_safe, with_chunks
from quarry.session import cut_lineage

DIGIT_CHOICES = (4, 5, 6)

UNB = Window.unboundedPreceding
CUR = Window.currentRow


def key_value_rank(df: DataFrame, order: EventOrder, value: str, threshold: int | None) -> DataFrame:
    """``key, ts, tie, _v, _rho``: the 0-based place of each row's value among its key's non-null values (equal
    values in event order), NULL for a NULL value.  ``threshold`` is None where no key has more values."""
    keys = [order.key, order.ts, order.tie]
    rows = df.select(*keys, F.col(value).alias("_v"))
    there = rows.where(F.col("_v").isNotNull())
    place = EventOrder(order.key, "_v", order.ts)
    size = F.col("_v").cast("double")
    hot = None if threshold is None else hot_key_chunks(there, place, threshold, time_us=size)
    there = with_chunks(there, place, hot, time_us=size)
    at = F.row_number().over(Window.partitionBy(order.key, CHUNK).orderBy("_v", order.ts, order.tie)) - 1
    ranked = there.withColumn("_rho", at.cast("long"))
    if hot is not None:
        sizes = there.where(F.col(HOT)).groupBy(order.key, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
        lower = sizes.select(order.key, CHUNK, F.sum("_n").over(Window.partitionBy(order.key).orderBy(CHUNK).rowsBetween(UNB, -1)).alias("_lower"))
        ranked = join_null_safe(ranked, lower, [order.key, CHUNK]).withColumn("_rho", F.col("_rho") + F.coalesce("_lower", F.lit(0)))
    without = rows.where(F.col("_v").isNull()).withColumn("_rho", F.lit(None).cast("long"))
    return ranked.select(*keys, "_v", "_rho").unionByName(without)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def digit_plan(n_vals: int) -> tuple[int, int]:
    """``(digit_bits, levels)`` for ranks ``0 … n_vals - 1``: the fewest
    levels (each level is one shuffle), then the narrowest digit (each digit
    value is one window counter)."""
    bits = max(1, max(n_vals - 1, 0).bit_length())
    return min(((b, -(-bits // b)) for b in DIGIT_CHOICES), key=lambda t: (t[1], t[0]))


def prior_quantile(df: DataFrame, order: EventOrder, value: str, q: float, *,
                   hot_threshold: int | None = None) -> DataFrame:
    """``(key, ts, tie, _pq)``: the q-quantile (linear interpolation, as
    ``percentile``) of the key's non-null values strictly before each row in
    ``(ts, tie)`` order; rows without earlier values are absent."""
    if not 0.0 <= q <= 1.0:
        raise ValueError(f"quantile must be in [0, 1], got {q}")
    threshold = hot_key_rows(df.sparkSession, hot_threshold)
    longest, most = df.groupBy(order.key).agg(F.count(F.lit(1)).alias("_a"), F.count(value).alias("_n")).agg(F.max("_a"), F.max("_n")).first()
    hot = hot_key_chunks(df, order, threshold) if (longest or 0) > threshold else None
    ranked = key_value_rank(df, order, value, threshold if (most or 0) > threshold else None)
    bits, levels = digit_plan(most or 0)
    fan = 1 << bits
    keys = [order.key, order.ts, order.tie]

    base = cut_lineage(with_chunks(ranked, order, hot).select(*keys, CHUNK, HOT, "_v", "_rho"), "quantile-base")
    # one query row per event; _m: 2 = both ranks (lo, lo + 1) in this
    # prefix group, 0 = lo only, 1 = hi only (after the two ranks part)
    qs = base.select(*keys, CHUNK, HOT, F.lit(2).alias("_m"), F.lit(0).cast("long").alias("_pre"),
                     F.lit(None).cast("long").alias("_k"), F.lit(None).cast("long").alias("_n"))

    for lvl in range(levels):
        shift = bits * (levels - 1 - lvl)
        last = lvl == levels - 1
        data = base.where(F.col("_rho").isNotNull()).select(
            *keys, CHUNK, HOT, F.lit(1).alias("_kind"),
            F.shiftright("_rho", shift + bits).alias("_pre"),
            F.shiftright("_rho", shift).bitwiseAND(fan - 1).cast("int").alias("_dg"),
            *([F.col("_v")] if last else []))
        u = qs.withColumn("_kind", F.lit(0)).unionByName(data, allowMissingColumns=True)
        # wide expression lists are written as SQL text: one call to the JVM
        # per list instead of one per operator
        over = (f"over (partition by {_q(order.key)}, {CHUNK}, _pre order by {_q(order.ts)}, "
                f"{_q(order.tie)}, _kind rows between unbounded preceding and current row)")
        # _c{d}: earlier data rows of this prefix group whose digit is <= d
        aggs = [f"count_if(_kind = 1 and _dg <= {d}) {over} as _c{d}" for d in range(fan)]
        if last:
            aggs += [f"max(case when _kind = 1 and _dg = {d} then _v end) {over} as _x{d}" for d in range(fan)]
        res = u.selectExpr("*", *aggs).where(F.col("_kind") == 0)
        if hot is not None:
            res = _add_carry(res, data, qs, order, fan, last)
        if lvl == 0:
            h = f"(_c{fan - 1} - 1) * {float(q)!r}D"
            res = (res.withColumn("_n", F.col(f"_c{fan - 1}")).where(F.col("_n") > 0)
                      .withColumns({"_k": F.expr(f"cast(floor({h}) as bigint)"),
                                    "_m": F.expr(f"case when floor({h}) = ceil({h}) then 0 else 2 end")}))

        def pick(k: str) -> tuple[Column, Column]:
            """(digit, rows of the group below that digit) for 0-based rank k."""
            digit = " + ".join(f"cast(_c{d} <= {k} as int)" for d in range(fan))
            below = "coalesce(greatest({}), 0)".format(
                ", ".join(f"case when _c{d} <= {k} then _c{d} end" for d in range(fan)))
            return F.expr(digit), F.expr(below)

        d_a, b_a = pick("_k")
        d_b, b_b = pick("(_k + 1)")
        res = res.withColumns({"_da": d_a, "_ba": b_a, "_db": d_b, "_bb": b_b})
        pair = F.col("_m") == 2
        if last:
            vals = F.expr("array({})".format(", ".join(f"_x{d}" for d in range(fan))))
            x_a = F.element_at(vals, (F.col("_da") + 1).cast("int"))
            x_b = F.element_at(vals, (F.col("_db") + 1).cast("int"))
            qs = res.select(*keys, "_n",
                            F.when(F.col("_m") != 1, x_a).alias("_xlo"),
                            F.when(F.col("_m") == 1, x_a).when(pair, x_b).alias("_xhi"))
            break
        split = pair & (F.col("_da") != F.col("_db"))
        a = F.struct(F.when(split, F.lit(0)).otherwise(F.col("_m")).alias("m"),
                     (F.col("_pre") * F.lit(fan) + F.col("_da")).alias("pre"),
                     (F.col("_k") - F.col("_ba")).alias("k"))
        b = F.struct(F.lit(1).alias("m"), (F.col("_pre") * F.lit(fan) + F.col("_db")).alias("pre"),
                     (F.col("_k") + 1 - F.col("_bb")).alias("k"))
        qs = (res.select(*keys, CHUNK, HOT, "_n",
                         F.explode(F.when(split, F.array(a, b)).otherwise(F.array(a))).alias("_q"))
                 .select(*keys, CHUNK, HOT, F.col("_q.m").alias("_m"), F.col("_q.pre").alias("_pre"),
                         F.col("_q.k").alias("_k"), "_n"))
        if hot is not None:
            # the carry reads the query state twice (probes and window input)
            qs = cut_lineage(qs, f"quantile-level{lvl}")

    per_row = qs.groupBy(*keys).agg(F.max("_xlo").cast("double").alias("_lo"),
                                    F.max("_xhi").cast("double").alias("_hi"), F.max("_n").alias("_n"))
    h = (F.col("_n") - F.lit(1)).cast("double") * F.lit(float(q))
    lo, hi = F.floor(h), F.ceil(h)
    pq = F.when(lo == hi, F.col("_lo")).otherwise((hi - h) * F.col("_lo") + (h - lo) * F.col("_hi"))
    return per_row.select(*keys, pq.alias("_pq"))


def _add_carry(res: DataFrame, data: DataFrame, qs: DataFrame, order: EventOrder, fan: int,
               last: bool) -> DataFrame:
    """Add the digit counts (and, on the last level, digit values) of the
    earlier chunks of hot keys to each query row's in-chunk counts."""
    k = order.key
    summ = data.where(F.col(HOT)).groupBy(k, CHUNK, "_pre").agg(
        *[F.expr(f"count_if(_dg <= {d}) as _c{d}") for d in range(fan)],
        *([F.expr(f"max(case when _dg = {d} then _v end) as _x{d}") for d in range(fan)] if last else []))
    probes = qs.where(F.col(HOT)).select(k, CHUNK, "_pre").distinct()
    cu = (probes.withColumn("_kind", F.lit(0))
                .unionByName(summ.withColumn("_kind", F.lit(1)), allowMissingColumns=True))
    # a probe sorts before its own chunk's summary: only earlier chunks count
    over = (f"over (partition by {_q(k)}, _pre order by {CHUNK}, _kind "
            "rows between unbounded preceding and current row)")
    carry = cu.selectExpr(
        _q(k), CHUNK, "_pre", "_kind",
        *[f"sum(_c{d}) {over} as _k{d}" for d in range(fan)],
        *([f"max(_x{d}) {over} as _y{d}" for d in range(fan)] if last else []),
    ).where(F.col("_kind") == 0).drop("_kind")
    out = join_null_safe(res, carry, [k, CHUNK, "_pre"])
    upd = [f"_c{d} + coalesce(_k{d}, 0) as _c{d}" for d in range(fan)]
    if last:
        upd += [f"coalesce(_x{d}, _y{d}) as _x{d}" for d in range(fan)]
    kept = [_q(c) for c in out.columns if not (c[:2] in ("_c", "_k", "_x", "_y") and c[2:].isdigit())]
    return out.selectExpr(*kept, *upd)
