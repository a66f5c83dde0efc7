"""Corpus counts of tokens, pre-aggregated in the tasks that read the texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct tokens that a task holds before it passes its counts on.
FLUSH_AT = 400_000


def count_tokens(docs: DataFrame, split: Callable[[str], list[str]], text_col: str = "text", group_col: str | None = None) -> DataFrame:
    """``[grp,] token, n``: occurrences over all rows of what ``split`` finds in a text.

    Each task counts what it reads and passes on partial counts, of at most
    ``FLUSH_AT`` distinct tokens at a time; the shuffle sums them.  Null texts
    have no tokens.
    """
    grouped = group_col is not None
    src = docs.select(F.col(group_col).alias("grp") if grouped else F.lit("").alias("grp"), F.col(text_col).alias("text"))

    def batches(counts: dict) -> Iterator[pa.RecordBatch]:
        for g, c in counts.items():
            yield pa.record_batch([pa.array([g] * len(c), pa.string()), pa.array(list(c), pa.string()),
                                   pa.array(list(c.values()), pa.int64())], names=["grp", "token", "n"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for b in it:
            for g, t in zip(b.column(0).to_pylist(), b.column(1)):
                s = t.as_py()
                if s:
                    c = counts.get(g)
                    if c is None:
                        c = counts[g] = Counter()
                    c.update(split(s))
                    if len(c) > FLUSH_AT:
                        yield from batches({g: counts.pop(g)})
        yield from batches(counts)

    keys = ["grp", "token"] if grouped else ["token"]
    return src.mapInArrow(run, "grp string, token string, n long").groupBy(*keys).agg(F.sum("n").alias("n"))
