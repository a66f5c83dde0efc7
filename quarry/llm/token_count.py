"""Token counts: count-only Viterbi over Aho-Corasick matches of a unigram vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarry.llm.unigram import PieceCounts, Pieces, chunks


def count_pieces(docs: DataFrame, pieces: Pieces, text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with ``out`` (long): pieces of the best segmentation of the whole text.

    No shuffle: the vocabulary, fixed in size, goes to the tasks, and each
    task solves a distinct chunk once.  A null or empty text has 0 pieces;
    repeated rows each get their row; a column named ``out`` is replaced.
    """
    src = docs.drop(out)
    at = src.columns.index(text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = PieceCounts(pieces)
        get = counts.__getitem__
        for b in it:
            n = [sum(map(get, chunks(t.as_py() or ""))) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64())], names=[*b.schema.names, out])

    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField(out, T.LongType())]))
