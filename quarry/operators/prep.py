"""Imputation and encoding statistics (A3–A5, M2–M4).

Order statistics of all columns are found together, without gathering a column
in one task.  Each round is one partial-aggregated histogram (counts, min, max
per bucket; at most ``BUCKETS`` rows come back for each rank wanted) over the
current value range of every rank; the bucket that holds a rank is its next
range, until the range is one value.  The first round's buckets are
logarithmic and the later ones linear, so a double is settled in a few rounds
whatever the spread.  NULL and NaN have no rank; infinities have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.keyed import by_ranges

NULL_CATEGORY = "__null__"
BUCKETS = 4096


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """``c, x``: the non-null, non-NaN values of the columns, one row each."""
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("x")) for c in columns])
    return df.select(F.explode(cells).alias("_e")).select("_e.c", "_e.x").where(F.col("x").isNotNull() & ~F.isnan("x"))


def _spread(x: Column) -> Column:
    return F.signum(x) * F.log1p(F.abs(x))


def column_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict[str, dict[float, float | None]]:
    """Linear-interpolation quantiles (``quantile_cont`` / ``percentile``) of every column."""
    inf = float("inf")
    values = _long(df, list(columns))
    finite = F.when(F.abs("x") != F.lit(inf), F.col("x"))
    sizes = {r["c"]: r for r in values.groupBy("c").agg(
        F.count("x").alias("n"), F.count_if(F.col("x") == -inf).alias("low"), F.count_if(F.col("x") == inf).alias("high"),
        F.min(finite).alias("lo"), F.max(finite).alias("hi")).collect()}
    found: dict[tuple[str, int], float] = {}
    open_: dict[tuple[str, int], list] = {}
    places: dict[str, dict[float, tuple[int, int, float]]] = {}
    for c, r in sizes.items():
        places[c] = {}
        for p in probs:
            h = (r["n"] - 1) * p
            a = int(h // 1)
            b = min(a + 1, r["n"] - 1)
            places[c][p] = (a, b, h - a)
            for k in (a, b):
                if k < r["low"]:
                    found[c, k] = -inf
                elif k >= r["n"] - r["high"]:
                    found[c, k] = inf
                elif r["lo"] == r["hi"]:
                    found[c, k] = r["lo"]
                else:
                    open_[c, k] = [r["lo"], r["hi"], r["low"]]  # range, and rows below it
    first = True
    while open_:
        rows = [(c, k, lo, hi) for (c, k), (lo, hi, _) in open_.items()]
        # two ranks for each column and probability
        targets = F.broadcast(df.sparkSession.createDataFrame(rows, "c string, k long, lo double, hi double"))
        g = _spread if first else (lambda x: x / 2)  # halves: a difference of doubles must not overflow
        x, lo, hi = g(F.col("x")), g(F.col("lo")), g(F.col("hi"))
        share = F.when(hi > lo, (x - lo) / (hi - lo)).otherwise(0.0)
        bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))
        hist: dict[tuple[str, int], list] = {}
        for r in (values.join(targets, "c").where(F.col("x").between(F.col("lo"), F.col("hi")))
                  .groupBy("c", "k", bucket.alias("b")).agg(F.count("x").alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx"))
                  .orderBy("c", "k", "b").collect()):
            hist.setdefault((r["c"], r["k"]), []).append(r)
        for at, buckets in hist.items():
            below = open_[at][2]
            for r in buckets:
                if below + r["n"] > at[1]:
                    break
                below += r["n"]
            if r["mn"] == r["mx"]:
                found[at] = r["mn"]
                del open_[at]
            else:
                open_[at] = [r["mn"], r["mx"], below]
        first = False
    out: dict[str, dict[float, float | None]] = {c: {p: None for p in probs} for c in columns}
    for c, by_p in places.items():
        for p, (a, b, part) in by_p.items():
            u, v = found[c, a], found[c, b]
            out[c][p] = u if part == 0 or u == v else u + (v - u) * part
    return out


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> dict[float, float | None]:
    return column_quantiles(df, [col], probs)[col]


def fit_medians(df: DataFrame, columns, method: str = "exact", relative_error: float = 1e-4) -> dict:
    """Median per column: ``exact`` (distributed selection) or ``approx``
    (``percentile_approx`` sketch, one pass for all columns)."""
    if method == "approx":
        acc = int(1 / relative_error)
        row = df.agg(*[F.percentile_approx(c, 0.5, acc).alias(c) for c in columns]).first()
        return {c: row[c] for c in columns}
    return {c: q[0.5] for c, q in column_quantiles(df, list(columns), [0.5]).items()}


def impute(df: DataFrame, fills: dict) -> DataFrame:
    """coalesce each column with its fitted literal (narrow, codegen)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items() if v is not None})


def mode_table(df: DataFrame, col: str) -> DataFrame:
    """One row: the most frequent non-null value, smallest among ties.

    Counts are a partial aggregate; the winner is a global ``min`` over
    ``(-count, value)``, also partial — no task holds the whole domain."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    best = counts.agg(F.min(F.struct((-F.col("_c")).alias("nc"), F.col(col).alias("v"))).alias("_m"))
    return best.select(F.col("_m.v").alias("mode"), (-F.col("_m.nc")).alias("n_rows"))


def fit_modes(df: DataFrame, columns) -> dict:
    """Mode of every column, in one job: all columns' values are counted together."""
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    counts = (df.select(F.explode(cells).alias("_e")).select("_e.c", "_e.v").where(F.col("v").isNotNull())
              .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
    # strings compare as text, so ties of other types are settled in their own type
    typed = [F.when(F.col("c") == c, F.col("v")).cast(df.schema[c].dataType).alias(f"t{i}") for i, c in enumerate(columns)]
    best = counts.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("n"), *typed)).alias("m")).collect()
    return {c: None for c in columns} | {r["c"]: r["m"][1 + list(columns).index(r["c"])] for r in best}


def boolean_as_category(col: str):
    """Boolean → 'true' / 'false' / '__null__' (null is a category)."""
    return F.coalesce(F.lower(F.col(col).cast("string")), F.lit(NULL_CATEGORY))


def value_ranges(df: DataFrame, columns) -> DataFrame:
    """``column_name, value, _r``: the distinct non-null values, cut into ranges by value, so that values with
    one beginning spread like any others."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    domain = df.select(F.explode(cells).alias("_e")).select("_e.column_name", "_e.value").where(F.col("value").isNotNull()).distinct()
    return by_ranges(domain, ["column_name", "value"], "vocabulary")


def vocabulary(df: DataFrame, columns) -> DataFrame:
    """(column_name, value, slot) with slots in ascending value order.

    Values are ranked within their range and the ranges' sizes are added up,
    so no task holds a column's whole domain."""
    ranges = value_ranges(df, columns)
    sizes = ranges.groupBy("column_name", "_r").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("column_name").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("column_name", "_r", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_at"))
    inside = F.row_number().over(Window.partitionBy("column_name", "_r").orderBy("value"))
    return (ranges.withColumn("_i", inside - 1).join(starts, ["column_name", "_r"])
            .select("column_name", "value", (F.col("_at") + F.col("_i")).cast("int").alias("slot")))


def encode_rows(df: DataFrame, ids: list[str], columns, vocab: DataFrame) -> DataFrame:
    """``ids, column_name, slot``: the slot of every cell of ``columns`` by a fitted ``vocabulary`` table.

    NULL and values unseen when fitting yield no row.  The vocabulary is joined
    and never listed on the driver, so its size has no bound; it has one row
    for each value, and the cells of a frequent value are split by the skew
    join of adaptive execution."""
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    long = df.select(*ids, F.explode(cells).alias("_e")).select(*ids, F.col("_e.c").alias("_c"), F.col("_e.v").alias("_v"))
    slots = vocab.select(F.col("column_name").alias("_c"), F.col("value").alias("_v"), F.col("slot").alias("_slot"))
    return (long.where(F.col("_v").isNotNull()).join(slots, ["_c", "_v"])
            .select(*ids, F.col("_c").alias("column_name"), F.col("_slot").alias("slot")))
