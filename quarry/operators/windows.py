"""Per-key behavioural features over event order.

All features of one call share one window specification, so the plan has a
single Exchange on ``(key, _chunk)`` and one Sort before the Window node(s).

Row-ordered features (``sequence_features``): expanding count, mean,
population stddev and max (current row included), value/mean ratio, the
``value > 2 × mean`` flag, number of previous events, sum of the last *k*
values with *k* per row, minutes since and planar distance from the previous
event.  For hot keys (see ``keyed``) they are computed per time chunk and the
state of earlier chunks is merged in from a carry table:
counts and sums add, ``M2`` merges with Chan's formula, max takes the
greater, the previous row is the previous chunk's last row and the last-k
window continues into the previous chunks' last values (see ``lastk``).

Interval features: events in the last 1 h / 24 h / 7 d (``interval_counts``,
running sums of arrivals and expiries) and sums, means, deviations and
extremes of their values (``interval_stats``, see ``frames``); RANGE frames,
current row and ties included.

``prior_quantile_flag`` compares each value with the exact quantile of the
key's earlier values by radix descent over value ranks (``orderstat``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalar import epoch_micros
from quarry.operators.frames import moving_stats
from quarry.operators.keyed import CHUNK, HOT, EventOrder, hot_key_chunks, hot_key_rows, join_null_safe, with_chunks
from quarry.operators.lastk import SHORT, add_long, direct_sum, has_long, lags, recent
from quarry.operators.orderstat import prior_quantile

UNB = Window.unboundedPreceding
CUR = Window.currentRow

# Planar distance: degrees to km, as the reference computes it (fixed value).
KM_PER_DEGREE = 111.0


def sequence_features(df: DataFrame, order: EventOrder, value: str, *,
                      k_col: str | None = None,
                      lat: str | None = None, lon: str | None = None,
                      hot_threshold: int | None = None, prefix: str = "") -> DataFrame:
    """Add expanding / lag / last-k features; returns input columns + features.

    Output columns (``prefix`` prepended): ``exp_count``, ``exp_mean``,
    ``exp_std``, ``exp_max``, ``value_ratio``, ``above_2x_mean``,
    ``prior_count``, ``minutes_since_prev``; ``last_k_sum`` when ``k_col``;
    ``dist_prev_km`` when ``lat``/``lon``.  ``last_k_sum`` adds the non-null
    values among the last ``k`` rows, whatever the largest ``k`` is.
    """
    spark = df.sparkSession
    threshold = hot_key_rows(spark, hot_threshold)
    hot = hot_key_chunks(df, order, threshold)
    base = with_chunks(df, order, hot)
    in_cols = df.columns

    w = Window.partitionBy(order.key, CHUNK).orderBy(order.ts, order.tie)
    grow = w.rowsBetween(UNB, CUR)
    v = F.col(value)
    local = {
        "_n": F.count(v).over(grow),
        "_rows": F.row_number().over(w),
        "_mean": F.avg(v).over(grow),
        "_var": F.var_pop(v).over(grow),
        "_max": F.max(v).over(grow),
        "_prev_ts": F.lag(order.ts, 1).over(w),
    }
    if lat and lon:
        local["_prev_lat"] = F.lag(lat, 1).over(w)
        local["_prev_lon"] = F.lag(lon, 1).over(w)
    if k_col:
        local |= lags(v, w)
    loc = base.withColumns(local)

    carry = hot is not None
    withc = _attach_carry(loc, order, value, lat, lon, k_col) if carry else loc

    if carry:
        # merge (n, mean, M2) of earlier chunks with the in-chunk running
        # state (Chan et al.); try_divide: chunks may hold only NULL values
        n_b = F.col("_cn")
        n_l = F.col("_n")
        n_tot = F.coalesce(n_b, F.lit(0)) + n_l
        m2_l = F.coalesce(F.col("_var") * n_l, F.lit(0.0))
        mean = F.when(F.col("_cmean").isNull(), F.col("_mean")).when(F.col("_mean").isNull(), F.col("_cmean")).otherwise(
            F.col("_cmean") + (F.col("_mean") - F.col("_cmean")) * F.try_divide(n_l, n_tot))
        delta = F.coalesce(F.col("_mean") - F.col("_cmean"), F.lit(0.0))
        m2 = (F.coalesce(F.col("_cm2"), F.lit(0.0)) + m2_l
              + F.coalesce(F.try_divide(delta * delta * n_b * n_l, n_tot), F.lit(0.0)))
        std = F.when(n_b.isNull(), F.sqrt(F.col("_var"))).when(
            n_tot > 0, F.sqrt(F.greatest(F.try_divide(m2, n_tot), F.lit(0.0))))
        vmax = F.greatest(F.col("_max"), F.col("_cmax"))
        rows = F.coalesce(F.col("_crows"), F.lit(0)) + F.col("_rows")
        first = F.col("_rows") == 1

        def prev(local_col: str, carried: str) -> Column:
            return F.when(first, F.col(f"_cprev.{carried}")).otherwise(F.col(local_col))
    else:
        mean, std, vmax, rows = F.col("_mean"), F.sqrt(F.col("_var")), F.col("_max"), F.col("_rows")

        def prev(local_col: str, carried: str) -> Column:
            return F.col(local_col)

    prev_ts = prev("_prev_ts", "_ts")
    minutes = (epoch_micros(order.ts) - epoch_micros(prev_ts)) / F.lit(6e7)

    p = prefix
    out = withc.withColumns({
        f"{p}exp_count": rows.cast("long"),
        f"{p}exp_mean": mean,
        f"{p}exp_std": std,
        f"{p}exp_max": vmax,
        f"{p}minutes_since_prev": minutes,
    })
    out = out.withColumns({
        f"{p}value_ratio": F.when(F.col(f"{p}exp_mean") != 0, v / F.col(f"{p}exp_mean"))
                            .otherwise(F.lit(1.0)),
        f"{p}above_2x_mean": v > F.lit(2.0) * F.col(f"{p}exp_mean"),
        f"{p}prior_count": F.col(f"{p}exp_count") - 1,
    })
    if lat and lon:
        dlat = F.col(lat) - prev("_prev_lat", "_lat")
        dlon = F.col(lon) - prev("_prev_lon", "_lon")
        out = out.withColumn(f"{p}dist_prev_km",
                             F.sqrt(dlat * dlat + dlon * dlon) * F.lit(KM_PER_DEGREE))
    if k_col:
        name, number = f"{p}last_k_sum", f"{p}exp_count"
        k = F.greatest(F.col(k_col).cast("long"), F.lit(1))
        values = recent(v, F.col("_rows"), F.col("_ctail") if carry else None)
        out = out.withColumn(name, direct_sum(values, k))
        if has_long(df, k_col):
            own = direct_sum(values, (F.col(number) - 1) % SHORT + 1)
            out = out.withColumn("_own", own).select(*in_cols, "_own", *[c for c in out.columns if c.startswith(p) and c not in in_cols and not c.startswith("_")])
            out = add_long(out, order.key, number, value, k, F.col("_own"), name)
    keep = in_cols + [c for c in out.columns if c.startswith(p) and c not in in_cols
                      and not c.startswith("_")]
    return out.select(*keep)


def _attach_carry(loc: DataFrame, order: EventOrder, value: str, lat, lon, k_col) -> DataFrame:
    """Join each hot chunk's carry (state of all earlier chunks of its key).

    The summary has one row per hot chunk (the chunk's last row); the carry is
    a window over that small table; both are bounded by the hot-key plan.
    """
    last_struct = {"_ts": F.col(order.ts)}
    if lat and lon:
        last_struct["_lat"] = F.col(lat)
        last_struct["_lon"] = F.col(lon)
    # the last values of a chunk, latest first
    tail = (F.slice(F.array(*recent(F.col(value), F.col("_rows"), None)), F.lit(1), F.least(F.col("_rows"), F.lit(SHORT))) if k_col
            else F.lit(None).cast("array<double>"))
    summary_row = F.struct(
        F.col("_n").alias("n"), F.col("_rows").alias("rows"), F.col("_mean").alias("mean"),
        (F.col("_var") * F.col("_n")).alias("m2"), F.col("_max").alias("mx"),
        F.struct(*[c.alias(k) for k, c in last_struct.items()]).alias("last"),
        tail.alias("tail"))
    summary = (loc.where(F.col(HOT))
                  .groupBy(order.key, CHUNK)
                  .agg(F.max_by(summary_row, F.col("_rows")).alias("s"))
                  .select(order.key, CHUNK, "s.*"))
    pw = Window.partitionBy(order.key).orderBy(CHUNK)
    before = pw.rowsBetween(UNB, -1)
    # sums are taken around a mean of the key, so that their squares do not cancel
    near = F.first("mean", ignorenulls=True).over(pw.rowsBetween(UNB, Window.unboundedFollowing))
    centred = summary.withColumn("_at", near).withColumn("_d", F.col("mean") - F.col("_at"))
    carry = centred.select(
        order.key, CHUNK, "_at",
        F.sum("n").over(before).alias("_cn"),
        F.sum("rows").over(before).alias("_crows"),
        F.sum(F.coalesce(F.col("n") * F.col("_d"), F.lit(0.0))).over(before).alias("_cs"),
        F.sum(F.coalesce(F.col("m2") + F.col("n") * F.col("_d") * F.col("_d"), F.lit(0.0))).over(before).alias("_cq"),
        F.max("mx").over(before).alias("_cmax"),
        F.lag("last", 1).over(pw).alias("_cprev"),
        F.slice(F.flatten(F.reverse(F.collect_list("tail").over(pw.rowsBetween(-SHORT, -1)))), 1, SHORT).alias("_ctail"),
    )
    shift = F.try_divide(F.col("_cs"), F.col("_cn"))
    carry = carry.select(order.key, CHUNK, "_cn", "_crows", (F.col("_at") + shift).alias("_cmean"),
                         F.greatest(F.col("_cq") - F.col("_cs") * shift, F.lit(0.0)).alias("_cm2"), "_cmax", "_cprev", "_ctail")
    return join_null_safe(loc, carry, [order.key, CHUNK])


def interval_counts(df: DataFrame, order: EventOrder, widths: dict[str, int], *,
                    hot_threshold: int | None = None) -> DataFrame:
    """Events of the same key in ``[ts - width, ts]`` for each named width (s).

    Each event also emits one expiry per distinct width at ``ts + width``; a
    count is the running sum of ``+1`` (arrivals) and ``-1`` (expiries strictly
    before ``ts``), in one shuffle for all widths; as integers the sums
    are exact, and the carry of earlier hot-key chunks adds to them.
    """
    spark = df.sparkSession
    hot = hot_key_chunks(df, order, hot_key_rows(spark, hot_threshold))
    seconds = sorted({int(s) for s in widths.values()})
    ts_us = epoch_micros(order.ts)
    stream = df.withColumns({"_time": ts_us, "_kind": F.lit(0), "_w": F.lit(-1)})
    for j, secs in enumerate(seconds):
        stream = stream.unionByName(df.select(order.key, (ts_us + F.lit(secs * 1_000_000)).alias("_time"), F.lit(1).alias("_kind"),
                                              F.lit(j).alias("_w")), allowMissingColumns=True)
    stream = with_chunks(stream, order, hot, time_us=F.col("_time"))
    signs = [F.when(F.col("_kind") == 0, F.lit(1)).when(F.col("_w") == j, F.lit(-1)).otherwise(F.lit(0)).cast("long") for j in range(len(seconds))]
    w = Window.partitionBy(order.key, CHUNK).orderBy("_time", "_kind").rangeBetween(UNB, CUR)
    out = stream.withColumns({f"_r{j}": F.sum(x).over(w) for j, x in enumerate(signs)}).where(F.col("_kind") == 0)
    if hot is not None:
        totals = stream.where(F.col(HOT)).groupBy(order.key, CHUNK).agg(*[F.sum(x).alias(f"_t{j}") for j, x in enumerate(signs)])
        before = Window.partitionBy(order.key).orderBy(CHUNK).rowsBetween(UNB, -1)
        carry = totals.select(order.key, CHUNK, *[F.sum(f"_t{j}").over(before).alias(f"_k{j}") for j in range(len(seconds))])
        out = join_null_safe(out, carry, [order.key, CHUNK])
        out = out.withColumns({f"_r{j}": F.col(f"_r{j}") + F.coalesce(f"_k{j}", F.lit(0)) for j in range(len(seconds))})
    return out.select(*df.columns, *[F.col(f"_r{seconds.index(int(s))}").alias(name) for name, s in widths.items()])


def interval_stats(df: DataFrame, order: EventOrder, value: str, specs: dict[str, tuple[str, int]], *,
                   hot_threshold: int | None = None) -> DataFrame:
    """Moving-frame count / sum / mean / std (population) / max / min over ``[ts - w, ts]``.

    ``specs``: ``{out_name: (stat, width_seconds)}``.  Each frame is made of
    its own rows alone, without subtraction (see ``frames``).
    """
    return moving_stats(df, order, value, specs, hot_key_rows(df.sparkSession, hot_threshold))


def prior_quantile_flag(df: DataFrame, order: EventOrder, value: str, q: float = 0.95,
                        out: str = "above_prior_p95", quantile_col: str | None = "prior_p95", *,
                        hot_threshold: int | None = None) -> DataFrame:
    """``value`` above the exact q-quantile (linear interpolation) of the key's
    earlier values; False for a key's first event.

    The quantile is an order statistic found by radix descent over value ranks
    (``orderstat``): linear in the history length, exact and hot-key safe."""
    pq = prior_quantile(df, order, value, q, hot_threshold=hot_threshold).select(
        F.col(order.key).alias("_jk"), F.col(order.ts).alias("_jts"), F.col(order.tie).alias("_jtie"), "_pq")
    cond = (df[order.key].eqNullSafe(pq["_jk"]) & df[order.ts].eqNullSafe(pq["_jts"])
            & df[order.tie].eqNullSafe(pq["_jtie"]))
    res = df.join(pq, cond, "left").drop("_jk", "_jts", "_jtie")
    res = res.withColumn(out, F.coalesce(F.col(value) > F.col("_pq"), F.lit(False)))
    if quantile_col:
        res = res.withColumnRenamed("_pq", quantile_col)
    else:
        res = res.drop("_pq")
    return res


def latest_per_key(df: DataFrame, order: EventOrder, columns=None) -> DataFrame:
    """Latest row per key by ``(ts, tie)`` as an aggregate (partial on the map
    side), not a ranked window: a hot key costs one running max per task."""
    columns = [c for c in (columns or df.columns) if c != order.key]
    row = F.struct(*[F.col(c) for c in columns])
    by = F.struct(F.col(order.ts), F.col(order.tie))
    return (df.groupBy(order.key).agg(F.max_by(row, by).alias("_r"))
              .select(order.key, "_r.*"))
