"""Periodic runs of words through a dictionary of basic factors.

The dictionary names, for each power of two ``f``, the stretches of ``f``
words of a text: equal stretches have one name, and the names of length
``2f`` are pairs of names of length ``f``.  A stretch of smallest period ``q``
and at least ``q + f`` words, with ``f / 2 < q <= f``, holds each of its
``f``-word factors again exactly ``q`` words later and not before, since
such a factor covers a whole period.  So among the successor occurrences
within twice the length the starts of a run form arithmetic progressions of
difference ``q``: neighbouring starts of one difference propose a period, and
the stretch that they cover is the run, extended as far as it goes.  A period
is looked for at one ``f`` alone, so no run is proposed twice.

Factors that occur once in a text cannot begin a longer one that repeats, so
each length looks only at the starts that the shorter one left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: A run has at least this many words, and as many whole periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Bytes of text whose results a task holds at once.
PART_BYTES = 4 << 20

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])


class _Ids(dict):
    def __init__(self):
        self.next = count().__next__

    def __missing__(self, word):
        i = self[word] = self.next()
        return i


def runs_of(words: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """Rows (start, length, period) by start, then period: the runs of a sequence of word numbers.

    A run is a stretch of smallest period ``q``, ``least_words`` words and
    ``least_periods`` (3 or more) times ``q`` words at least, that no
    neighbouring word extends.
    """
    n, found = len(words), []
    names, starts, f = words.astype(np.int64), np.arange(n), 1
    while len(starts) and f < n:
        order = np.argsort(names, kind="stable")  # equal names side by side, by start
        by_name, at = names[order], starts[order]
        same = by_name[1:] == by_name[:-1]
        gap = at[1:] - at[:-1]
        near = same & (2 * gap > f) & (gap <= f)
        if near.any():
            found.append(_progressions(at[:-1][near], gap[near], f))
        repeated = np.zeros(len(order), bool)
        repeated[1:] = same
        repeated[:-1] |= same
        group = np.cumsum(np.append(True, ~same))
        full = np.zeros(n + f + 1, np.int64)  # name by start; 0 where the factor occurs once
        full[at[repeated]] = group[repeated]
        starts = np.nonzero(full[:n])[0]
        second = full[starts + f]
        starts, second = starts[second > 0], second[second > 0]
        names = full[starts] * (len(order) + 1) + second
        f *= 2
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[(runs[:, 1] >= least_words) & (runs[:, 1] >= least_periods * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _progressions(at: np.ndarray, gap: np.ndarray, f: int) -> np.ndarray:
    """Stretches (start, length, period) covered by neighbouring starts of one difference."""
    order = np.lexsort((at, gap))
    at, gap = at[order], gap[order]
    new = np.append(True, (at[1:] != at[:-1] + 1) | (gap[1:] != gap[:-1]))
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(at)) - 1
    return np.stack([at[first], at[last] - at[first] + gap[first] + f, gap[first]], axis=1)


def longest_power(runs: np.ndarray) -> int:
    """Row of the run with the greatest exact length / period; the first of equal ones."""
    best = 0
    for i, (_, length, period) in enumerate(runs.tolist()):
        if length * int(runs[best, 2]) > int(runs[best, 1]) * period:
            best = i
    return best


def covered(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words a run contains after its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(steps[:n]) > 0


def find_runs(docs: DataFrame, text_col: str = "text", id_col: str | None = None,
              reorder: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """``docs`` with the periodic runs of each whole text, and the text without their repetitions.

    New columns: ``n_words`` long; ``runs``, an array of (start, length,
    period) in words from 0, by start, then period; ``best``, the run of
    greatest length / period (ties: least start, then period; null without a
    run); ``collapsed``, the words that no run contains after its first
    period, joined by one space.  Words are ``[^\\x20\\x09-\\x0D]+``.
    ``reorder`` may replace the sequence looked at: from the value of
    ``id_col`` and the number of words it gives the word numbers to read, or
    None to leave them.

    A null or empty text, or one without words, has no words, no runs and an
    empty ``collapsed``; repeated rows each get their row; columns with the
    new names are replaced; an empty table stays empty.  A document is one
    row's work: no shuffle, n log n for each length that still repeats.
    """
    new = ["n_words", "runs", "best", "collapsed"]
    src = docs.drop(*new)
    at, key = src.columns.index(text_col), src.columns.index(id_col) if id_col else None

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for b in it:
            out, first, size = [], 0, 0
            for row in range(b.num_rows):
                text = (b.column(at)[row].as_py() or "").encode()
                words = text.split()
                ids = np.fromiter(map(_Ids().__getitem__, words), np.int64, len(words))
                turned = reorder(b.column(key)[row].as_py() if key is not None else None, len(words)) if reorder else None
                if turned is not None:
                    ids, words = ids[turned], [words[i] for i in turned.tolist()]
                runs = runs_of(ids)
                kept, best = words, None
                if len(runs):
                    best = longest_power(runs)
                    kept = [words[i] for i in np.nonzero(~covered(runs, len(words)))[0].tolist()]
                out.append((len(words), runs, best, b" ".join(kept).decode()))
                size += len(text)
                if size >= PART_BYTES or row == b.num_rows - 1:
                    every = np.concatenate([r for _, r, _, _ in out])
                    flat = pa.StructArray.from_arrays([pa.array(every[:, c]) for c in range(3)], fields=list(kind))
                    ends = np.cumsum([0] + [len(r) for _, r, _, _ in out])
                    top = [None if i is None else dict(zip(("start", "length", "period"), r[i].tolist())) for _, r, i, _ in out]
                    cols = [pa.array([n for n, _, _, _ in out], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                            pa.array(top, kind), pa.array([c for _, _, _, c in out], pa.string())]
                    part = b.slice(first, len(out))
                    yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=[*part.schema.names, *new])
                    out, first, size = [], row + 1, 0

    fields = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("best", RUN),
              T.StructField("collapsed", T.StringType())]
    return src.mapInArrow(run, T.StructType([*src.schema.fields, *fields]))
