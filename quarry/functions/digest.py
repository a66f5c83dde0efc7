"""Fingerprints: feature-set digest, per-row digest, order-free dataset digest.

Row encoding (fixed column order): every value is tagged with its kind and
strings are length-prefixed, so ``("a|b", "c")`` and ``("a", "b|c")`` encode
differently; NULL is a marker of its own.  Doubles are rendered with
``cast(d as string)`` (shortest exact form) unless the caller asks for a fixed
decimal rendering of chosen columns (used where another engine must reproduce
the bytes).

The dataset digest is the count plus the sum of 60-bit prefixes of the row
hashes, so it is independent of row order and partitioning and is computed
with a partial aggregate.  It is an integrity check, not collision resistant
against an adversary.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_MARK = "\\N"


def feature_set_digest(columns) -> str:
    """SHA-256 of the compact ASCII JSON list of names (driver-side)."""
    payload = json.dumps(list(columns), ensure_ascii=True, separators=(",", ":"))
    return hashlib.sha256(payload.encode("utf-8")).hexdigest()


def feature_set_digest_col(columns) -> Column:
    """Same digest as a column expression (``to_json`` of a string array)."""
    return F.sha2(F.to_json(F.array(*[F.lit(c) for c in columns])), 256)


def _encode(field: T.StructField, decimal_cols: dict) -> Column:
    c = F.col(field.name)
    dt = field.dataType
    if field.name in decimal_cols:
        p, s = decimal_cols[field.name]
        body = F.concat(F.lit("n"), c.cast(T.DecimalType(p, s)).cast("string"))
    elif isinstance(dt, T.StringType):
        body = F.concat(F.lit("s"), F.length(c).cast("string"), F.lit(":"), c)
    elif isinstance(dt, T.BooleanType):
        body = F.when(c, F.lit("bt")).otherwise(F.lit("bf"))
    elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        body = F.concat(F.lit("t"), F.unix_micros(c.cast("timestamp")).cast("string"))
    elif isinstance(dt, T.DateType):
        body = F.concat(F.lit("d"), F.date_format(c, "yyyy-MM-dd"))
    else:
        body = F.concat(F.lit("n"), c.cast("string"))
    return F.coalesce(body, F.lit(NULL_MARK))


def row_encoding(df: DataFrame, columns, decimal_cols: dict | None = None) -> Column:
    fields = {f.name: f for f in df.schema.fields}
    parts = [_encode(fields[c], decimal_cols or {}) for c in columns]
    return F.concat_ws("|", *parts)


def row_digest(df: DataFrame, columns, decimal_cols: dict | None = None) -> Column:
    """md5 hex of the row encoding over ``columns`` (content only)."""
    return F.md5(row_encoding(df, columns, decimal_cols))


def hash_prefix_60(hex_col: Column) -> Column:
    """First 15 hex digits of a hash as an exact decimal(38,0)."""
    return F.conv(F.substring(hex_col, 1, 15), 16, 10).cast(T.DecimalType(38, 0))


def dataset_digest(df: DataFrame, columns=None, decimal_cols: dict | None = None,
                   group_by=None) -> DataFrame:
    """One row (or one per group): n_rows, digest_sum, columns_digest.

    Partial aggregation: each task contributes one (count, sum) pair, so the
    cost is one narrow pass plus a tiny shuffle.
    """
    columns = list(columns or df.columns)
    h = hash_prefix_60(row_digest(df, columns, decimal_cols))
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.coalesce(F.sum(h), F.lit(0).cast(T.DecimalType(38, 0))).cast("string").alias("digest_sum")]
    grouped = df.groupBy(*group_by) if group_by else df
    out = grouped.agg(*aggs)
    return out.withColumn("columns_digest", F.lit(feature_set_digest(columns)))
