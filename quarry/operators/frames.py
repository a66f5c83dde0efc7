"""Moving-frame statistics over time, each frame built only from the rows in it.

For a frame ``[t - w, t]`` the time line of a key is laid out in tiles of the
frame's own width.  The frame is then the whole beginning of ``t``'s tile up
to ``t``, and the end of the tile before it from ``t - w`` on.  Both are
*growing* frames, one from the left and one from the right, so every row costs
two steps whatever the frame holds, and nothing is ever subtracted: a level
shift or one absurd value has no effect on a frame that does not contain it.
To meet in one partition, a row also goes to the next tile at ``t + w``, the
last moment at which it is seen: of the rows sent on, those with a later or
equal such time are in the frame.

The two halves are merged as (n, mean, M2), with sum, max and min beside it.

Hot keys (see ``keyed``) are also cut by the offset in the tile, at quantiles
of the key's offsets; a row and its copy in the next tile have the same
offset, so they stay in one partition ``(key, tile, cut)``.  Between the two
halves lie the later cuts of the tile before and the earlier cuts of this one:
whole pieces, whose summaries are merged in a binary tree of the tile's cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalar import epoch_micros
from quarry.operators.keyed import EventOrder, hot_row_cuts, join_null_safe, position_in
from quarry.session import cut_lineage

UNB, CUR = Window.unboundedPreceding, Window.currentRow
#: Statistics of a frame, and what each needs of its rows.
NEEDS = {"count": ("n",), "sum": ("n", "s"), "mean": ("n", "s"), "std": ("n", "s", "m2"), "max": ("hi",), "min": ("lo",)}


def of_rows(v: Column) -> dict[str, Column]:
    """Aggregates of a piece; ``m2`` is the sum of squares around the piece's own mean."""
    return {"n": F.count(v), "s": F.sum(v), "m2": F.var_pop(v), "hi": F.max(v), "lo": F.min(v)}


def merged(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """Two disjoint pieces as one; an empty piece has n = 0 (or null) and nulls."""
    an, bn = (F.coalesce(x["n"], F.lit(0)) if "n" in x else None for x in (a, b))
    out = {}
    if "n" in a:
        out["n"] = an + bn
    if "s" in a:
        out["s"] = F.coalesce(a["s"] + b["s"], a["s"], b["s"])
    if "m2" in a:
        apart = F.try_divide(b["s"], bn) - F.try_divide(a["s"], an)
        both = a["m2"] + b["m2"] + apart * apart * F.try_divide(an.cast("double") * bn, an + bn)
        out["m2"] = F.when(an == 0, b["m2"]).when(bn == 0, a["m2"]).otherwise(both)
    if "hi" in a:
        out["hi"] = F.greatest(a["hi"], b["hi"])
    if "lo" in a:
        out["lo"] = F.least(a["lo"], b["lo"])
    return out


def statistic(stat: str, p: dict[str, Column]) -> Column:
    """A statistic of a merged piece; NULL over no values, except a count of 0."""
    if stat == "count":
        return p["n"]
    if stat == "sum":
        return p["s"]
    if stat == "mean":
        return F.try_divide(p["s"], p["n"])
    if stat == "std":
        return F.when(p["n"] > 0, F.sqrt(F.greatest(F.try_divide(p["m2"], p["n"]), F.lit(0.0))))
    return p["hi" if stat == "max" else "lo"]


def moving_stats(df: DataFrame, order: EventOrder, value: str, specs: dict[str, tuple[str, int]], threshold: int) -> DataFrame:
    """``df`` with ``{out: (stat, seconds)}`` over ``[ts - seconds, ts]`` of its key.

    One shuffle for each distinct width, of every row and its copy (key, time
    and value alone).  NULL values are not counted; NaN and infinities
    make a sum, mean or std what they make of it in any SQL aggregate, for the
    frames that hold them; rows without a time see each other.
    """
    for st, _ in specs.values():
        if st not in NEEDS:
            raise ValueError(f"unsupported interval stat {st!r}")
    out = df
    for secs in sorted({int(s) for _, s in specs.values()}):
        out = _one_width(out, order, value, secs * 1_000_000, {n: st for n, (st, s) in specs.items() if int(s) == secs}, threshold)
    return out.select(*df.columns, *specs)


def _one_width(df: DataFrame, order: EventOrder, value: str, width: int, stats: dict[str, str], threshold: int) -> DataFrame:
    t, w = epoch_micros(order.ts), F.lit(width)
    need = sorted({x for st in stats.values() for x in NEEDS[st]} | ({"n", "s"} if "std" in stats.values() else set()))
    rows = df.withColumns({"_time": t, "_offset": F.pmod(t, w), "_v": F.col(value).cast("double")})
    rows = rows.withColumn("_tile", F.call_function("div", F.col("_time") - F.col("_offset"), w))
    cuts = hot_row_cuts(rows, order.key, "_tile", "_offset", threshold)
    rows = rows.withColumn("_cut", F.lit(0).cast("long")) if cuts is None else (
        join_null_safe(rows, cuts, [order.key])
        .withColumn("_cut", F.when(F.col("_offset").isNull(), F.lit(0)).otherwise(position_in("_bounds", F.col("_offset"))).cast("long")).drop("_bounds"))
    sent = rows.where(F.col("_time").isNotNull() & F.col("_v").isNotNull()).select(
        order.key, (F.col("_time") + w).alias("_time"), (F.col("_tile") + 1).alias("_tile"), "_cut", F.col("_v").alias("_past"), F.lit(True).alias("_sent"))
    stream = rows.unionByName(sent, allowMissingColumns=True)

    part = Window.partitionBy(order.key, "_tile", "_cut")
    ahead = part.orderBy(F.asc("_time")).rangeBetween(UNB, CUR)
    back = part.orderBy(F.desc("_time")).rangeBetween(UNB, CUR)
    now, past = of_rows(F.col("_v")), of_rows(F.col("_past"))
    seen = stream.withColumns({f"_a_{x}": now[x].over(ahead) for x in need}).withColumns({f"_b_{x}": past[x].over(back) for x in need})
    seen = seen.where(F.col("_sent").isNull())

    def piece(prefix: str, spread: bool = True) -> dict[str, Column]:
        p = {x: F.col(f"{prefix}{x}") for x in need}
        if spread and "m2" in p:  # var_pop so far
            p["m2"] = p["m2"] * p["n"]
        return p

    whole = merged(piece("_b_"), piece("_a_"))
    if cuts is not None:
        seen = join_null_safe(seen, _between(rows, cuts, order.key, need), [order.key, "_tile", "_cut"])
        whole = merged(piece("_m_", spread=False), whole)
    return seen.withColumns({n: statistic(st, whole) for n, st in stats.items()}).select(*df.columns, *stats)


def _between(rows: DataFrame, cuts: DataFrame, key: str, need: list[str]) -> DataFrame:
    """``key, _tile, _cut, _m_*``: the whole pieces between a frame's two halves, for the pieces of hot keys.

    The cuts of a tile are the leaves of a binary tree.  Those before a cut
    are one node for each set bit of its number, those after it one for each
    bit that is not set: one node a level, of this tile or of the one before.
    """
    hot = join_null_safe(rows, cuts, [key], "inner").where(F.col("_tile").isNotNull())
    agg = of_rows(F.col("_v"))
    leaf = hot.groupBy(key, "_tile", "_cut").agg(*[agg[x].alias(x) for x in need], F.max(F.size("_bounds")).alias("_last"))
    if "m2" in need:
        leaf = leaf.withColumn("m2", F.col("m2") * F.col("n"))
    leaf = cut_lineage(leaf.withColumn("_levels", F.length(F.bin(F.col("_last").cast("long")))), "pieces")

    def typed(p: dict[str, Column]) -> Column:
        return F.struct(*[p[x].cast("long" if x == "n" else "double").alias(x) for x in need])

    def folded(pieces: Column) -> Column:
        of = lambda p: {x: p[x] for x in need}
        return F.aggregate(F.slice(pieces, 2, F.size(pieces)), typed(of(pieces[0])), lambda a, b: typed(merged(of(a), of(b))))

    levels = F.sequence(F.lit(0), F.col("_levels") - 1)
    summary = F.struct(F.col("_cut").alias("_at"), *[F.col(x).cast("long" if x == "n" else "double").alias(x) for x in need])
    nodes = (leaf.select(key, "_tile", "_cut", summary.alias("_p"), F.explode(levels).alias("_level"))
             .withColumn("_node", F.call_function("div", F.col("_cut"), F.pow(F.lit(2), F.col("_level")).cast("long")))
             .groupBy(key, "_tile", "_level", "_node").agg(F.sort_array(F.collect_list("_p")).alias("_ps"))
             .select(key, "_tile", "_level", "_node", folded(F.col("_ps")).alias("_p")))
    asks = leaf.select(key, F.col("_tile").alias("_of"), "_cut", F.explode(levels).alias("_level"))
    asks = asks.withColumn("_up", F.call_function("div", F.col("_cut"), F.pow(F.lit(2), F.col("_level")).cast("long")))
    odd = F.col("_up") % 2 == 1
    asks = asks.select(key, "_of", "_cut", "_level", F.when(odd, F.col("_of")).otherwise(F.col("_of") - 1).alias("_tile"),
                       F.when(odd, F.col("_up") - 1).otherwise(F.col("_up") + 1).alias("_node"))
    found = join_null_safe(asks, nodes, [key, "_tile", "_level", "_node"], "inner")
    place = F.struct("_tile", (F.col("_node") * F.pow(F.lit(2), F.col("_level")).cast("long")).alias("_at"), *[F.col("_p")[x].alias(x) for x in need])
    return (found.groupBy(key, "_of", "_cut").agg(F.sort_array(F.collect_list(place)).alias("_ps"))
            .withColumn("_p", folded(F.col("_ps")))
            .select(key, F.col("_of").alias("_tile"), "_cut", *[F.col("_p")[x].alias(f"_m_{x}") for x in need]))
