"""Spans of texts: (kind, start, end) in code points, end exclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                     T.StructField("end", T.IntegerType())])


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)
