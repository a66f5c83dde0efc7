"""Raw → cleaned ingest and delayed label tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import standardise_columns


def clean(df: DataFrame, casts: dict[str, str], valid: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Standardise names, ``try_cast`` typed columns, split valid / quarantined.

    A row is invalid when a non-null source value fails its cast or the rule
    ``valid`` (over the cast columns) is not true.  Returns (clean rows,
    quarantined rows with a ``reason``).  Both are lazy filters of one
    projection; callers that need both should write them in one job."""
    std = standardise_columns(df)
    raw = {c: f"_raw_{c}" for c in casts}
    marked = std.select(*[F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c)
                          for c in std.columns],
                        *[F.col(c).alias(r) for c, r in raw.items()])
    cast_failed = F.lit(False)
    for c, r in raw.items():
        cast_failed = cast_failed | (F.col(r).isNotNull() & F.col(c).isNull())
    rule_ok = F.coalesce(valid, F.lit(False)) if valid is not None else F.lit(True)
    marked = marked.withColumns({
        "_ok": ~cast_failed & rule_ok,
        "reason": F.when(cast_failed, F.lit("cast")).when(~rule_ok, F.lit("rule")),
    })
    good = marked.where(F.col("_ok")).drop("_ok", "reason", *raw.values())
    quarantine = marked.where(~F.col("_ok")).drop("_ok", *raw.values())
    return good, quarantine


def delayed_labels(df: DataFrame, id_col: str, key: str, ts: str, label: Column, delay_days: Column) -> DataFrame:
    """Label table: (id, key, event_ts, label_ts = event_ts + delay, label)."""
    return df.select(F.col(id_col), F.col(key), F.col(ts).alias("event_ts"),
                     (F.col(ts) + F.make_dt_interval(days=delay_days.cast("int"))).alias("label_ts"),
                     label.alias("label"))
