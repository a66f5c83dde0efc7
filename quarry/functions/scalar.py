"""Scalar column helpers (all JVM built-ins, codegen friendly)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since epoch for TIMESTAMP or TIMESTAMP_NTZ columns."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def hour_of_day(ts: str) -> Column:
    return F.hour(F.col(ts))


def weekday_name(ts: str) -> Column:
    """Full English weekday name (e.g. ``Monday``)."""
    return F.date_format(F.col(ts), "EEEE")


def iso_timestamp(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def version_string(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def split_dataset_name(table: str | Column, split: str | Column,
                       version: str | Column | None = None) -> Column:
    """``{table with dots as _}_{split}[_v{n}]``."""
    t = F.lit(table) if isinstance(table, str) else table
    s = F.lit(split) if isinstance(split, str) else split
    base = F.concat(F.regexp_replace(t, r"\.", "_"), F.lit("_"), s)
    if version is None:
        return base
    v = F.lit(version) if not isinstance(version, Column) else version
    return F.when(v.isNull(), base).otherwise(F.concat(base, F.lit("_v"), v.cast("string")))


def standard_name(name: str) -> str:
    """snake_case: lower case, non-alphanumerics collapsed to ``_``."""
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    return s or "col"


def standardise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[standard_name(c) for c in df.columns])
