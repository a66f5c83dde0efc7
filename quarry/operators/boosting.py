"""Second-order boosted trees for a binary target, grown by a gang of tasks (M5–M8).

Rows are encoded once as small integers, one per source column: a numeric
column's quantile bin, a category's number.  The tasks of one barrier stage
each hold a share of them.  For every level of every tree a task sums
gradients and hessians per (node, column, bin) over its rows; the sums are
gathered from all tasks and added, and each task takes the same best splits
and moves its own rows on.  What is exchanged is a histogram, of at most
2^(depth-1) nodes x all bins, however many rows there are; rows never leave
their task.  A lost executor restarts the stage, whose rows, samples
and sums are functions of the input alone.

A split of a numeric column sends values up to a cut to the left, and learns
the side of missing ones.  A split of a category sets one of its values
against the others (a one-hot slot): a value that was not seen when fitting,
and a missing one, are none of them.  Leaves are ``-G / (H + l2)``.
"""

from __future__ import annotations

import base64
import json
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext, cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

# The reference learner's parameters (fixed values), and the defaults of its
# family for what it does not set: L2 weight, least hessian of a child.
DEFAULTS = {"n_estimators": 300, "max_depth": 6, "learning_rate": 0.05, "subsample": 0.8, "colsample": 0.8, "seed": 42,
            "l2": 1.0, "min_child_weight": 1.0, "max_bins": 256, "rows_per_task": 2_000_000}
# executors need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Least gain of a split.
LEAST_GAIN = 1e-6
#: Sample numbers of rows lie in [0, DRAWS).
DRAWS = 1 << 20


@dataclass
class Layout:
    """Encoded columns: cuts of the numeric ones, then sizes of the categories."""

    cuts: list[list[float]]
    sizes: list[int]

    def __post_init__(self):
        # bins of a numeric column: one more than cuts, and one for missing; of a category: its values, and one for others
        self.widths = np.array([len(c) + 2 for c in self.cuts] + [s + 1 for s in self.sizes], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.widths)])
        self.numeric = len(self.cuts)

    @property
    def slots(self) -> int:
        """Features in encoded order: numeric columns, then each category value."""
        return self.numeric + sum(self.sizes)

    def slot(self, column: int, at: int) -> int:
        return column if column < self.numeric else self.numeric + sum(self.sizes[:column - self.numeric]) + at


def encode(values: list[np.ndarray], layout: Layout) -> np.ndarray:
    """Bins of raw columns (NaN is missing): one row of small integers for each row."""
    out = np.empty((len(values[0]) if values else 0, len(values)), np.int32)
    for c, x in enumerate(values):
        if c < layout.numeric:
            bins = np.searchsorted(np.asarray(layout.cuts[c]), x, "left")
            out[:, c] = np.where(np.isnan(x), len(layout.cuts[c]) + 1, bins)
        else:
            size = layout.sizes[c - layout.numeric]
            out[:, c] = np.where((x >= 0) & (x < size), x, size)
    return out


def draw(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number in [0, DRAWS) for each row and tree, from the row's hash."""
    x = row.astype(np.uint64) + np.uint64((tree * 0x9E3779B97F4A7C15 + seed * 0xD6E8FEB86659FD93) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) % np.uint64(DRAWS)


def grow(codes: np.ndarray, y: np.ndarray, row: np.ndarray, layout: Layout, p: dict, total: Callable[[np.ndarray], np.ndarray]) -> tuple[float, list[dict]]:
    """Base margin and trees, from this task's rows and ``total``, which adds an array up over all tasks."""
    n, ones = total(np.array([len(y), y.sum()]))
    share = ones / n
    base = float(np.log(share / (1 - share)))
    margin, trees = np.full(len(y), base), []
    for t in range(int(p["n_estimators"])):
        prob = 1 / (1 + np.exp(-margin))
        g, h = prob - y, np.maximum(prob * (1 - prob), 1e-16)
        drawn = draw(row, t, int(p["seed"])) < p["subsample"] * DRAWS
        order = np.random.default_rng([int(p["seed"]), t]).permutation(layout.slots)
        allowed = np.zeros(layout.slots, bool)
        allowed[order[:max(1, int(p["colsample"] * layout.slots))]] = True
        tree = grow_tree(codes, np.where(drawn, g, 0.0), np.where(drawn, h, 0.0), layout, allowed, p, total)
        margin = margin + leaves_of(tree, lambda c, c_rows: codes[c_rows, c], layout, len(y), by_bin=True)
        trees.append(tree)
    return base, trees


def grow_tree(codes, g, h, layout: Layout, allowed, p, total) -> dict:
    """One tree, level by level: parallel lists by node, children after their parents."""
    tree = {k: [] for k in ("column", "at", "missing_left", "left", "right", "value", "gain")}

    def add() -> int:
        for k, v in (("column", -1), ("at", 0), ("missing_left", True), ("left", -1), ("right", -1), ("value", 0.0), ("gain", 0.0)):
            tree[k].append(v)
        return len(tree["column"]) - 1

    l2, least = p["l2"], p["min_child_weight"]
    node, open_, bins = np.zeros(len(g), np.int64), [add()], int(layout.first[-1])
    for depth in range(int(p["max_depth"]) + 1):
        inside = node >= 0
        sums = np.zeros((2, len(open_), bins))
        for c, width in enumerate(layout.widths):
            at = node[inside] * width + codes[inside, c]
            for k, weight in enumerate((g, h)):
                sums[k, :, layout.first[c]:layout.first[c + 1]] = np.bincount(at, weight[inside], len(open_) * width).reshape(len(open_), width)
        sums = total(sums)
        chosen = [best_split(sums[:, i], layout, allowed, l2, least) if depth < p["max_depth"] else None for i in range(len(open_))]
        grad, hess = (sums[k][:, :layout.first[1]].sum(axis=1) for k in (0, 1))
        nxt, into = [], np.full((len(open_), 2), -1)
        for i, (at, split) in enumerate(zip(open_, chosen)):
            if split is None:
                tree["value"][at] = float(-grad[i] / (hess[i] + l2) * p["learning_rate"])
                continue
            tree["column"][at], tree["at"][at], tree["missing_left"][at], tree["gain"][at] = split
            for side, name in enumerate(("left", "right")):
                tree[name][at] = add()
                into[i, side] = len(nxt)
                nxt.append(tree[name][at])
        if not nxt:
            break
        moved = np.full(len(node), -1, np.int64)
        for i, split in enumerate(chosen):
            if split is not None:
                rows = np.nonzero(node == i)[0]
                moved[rows] = into[i][goes_right(codes[rows, split[0]], split[0], split[1], split[2], layout).astype(int)]
        node, open_ = moved, nxt
    return tree


def goes_right(code, column: int, at: int, missing_left: bool, layout: Layout):
    if column >= layout.numeric:
        return code == at
    missing = code == layout.widths[column] - 1
    return np.where(missing, not missing_left, code > at)


def best_split(sums: np.ndarray, layout: Layout, allowed, l2: float, least: float):
    """(column, bin, missing goes left, gain) of the best split of a node, or None; the first of equal ones."""
    best = None
    for c in range(len(layout.widths)):
        g, h = sums[:, layout.first[c]:layout.first[c + 1]]
        gt, ht = g.sum(), h.sum()
        if c < layout.numeric:
            if not allowed[c]:
                continue
            known_g, known_h = np.cumsum(g[:-1]), np.cumsum(h[:-1])  # up to each bin, without the missing; the last: all but them
            options = [(known_g + g[-1], known_h + h[-1], True), (known_g, known_h, False)] if h[-1] > 0 else [(known_g, known_h, True)]
        else:
            at = layout.slot(c, 0)
            open_ = allowed[at:at + len(g) - 1]
            options = [(np.where(open_, gt - g[:-1], 0.0), np.where(open_, ht - h[:-1], 0.0), True)]
        for gl, hl, missing_left in options:
            if not len(gl):
                continue
            hr, gr = ht - hl, gt - gl
            gain = gl * gl / (hl + l2) + gr * gr / (hr + l2) - gt * gt / (ht + l2)
            gain = np.where((hl >= least) & (hr >= least), gain, -np.inf)
            k = int(gain.argmax())
            if gain[k] > LEAST_GAIN and (best is None or gain[k] > best[3]):
                best = (c, k, missing_left, float(gain[k]))
    return best


def leaves_of(tree: dict, value_of, layout: Layout, n: int, by_bin: bool) -> np.ndarray:
    """Leaf value of each row; ``value_of(column, rows)`` gives bins, or raw values (NaN is missing)."""
    node = np.zeros(n, np.int64)
    column, at, left, right = (np.asarray(tree[k]) for k in ("column", "at", "left", "right"))
    for parent in np.nonzero(column >= 0)[0].tolist():  # parents come before their children
        rows = np.nonzero(node == parent)[0]
        if not len(rows):
            continue
        x, c = value_of(column[parent], rows), column[parent]
        if by_bin:
            goes = goes_right(x, c, at[parent], tree["missing_left"][parent], layout)
        elif c >= layout.numeric:
            goes = x == at[parent]
        else:
            cut = layout.cuts[c][at[parent]] if at[parent] < len(layout.cuts[c]) else np.inf
            goes = np.where(np.isnan(x), not tree["missing_left"][parent], x > cut)
        node[rows] = np.where(goes, right[parent], left[parent])
    return np.asarray(tree["value"])[node]


def margins(trees: list[dict], base: float, columns: list[np.ndarray], layout: Layout) -> np.ndarray:
    out = np.full(len(columns[0]) if columns else 0, base)
    for tree in trees:
        out = out + leaves_of(tree, lambda c, rows: columns[c][rows], layout, len(out), by_bin=False)
    return out


def quantile_cuts(df: DataFrame, columns: list[str], max_bins: int) -> list[list[float]]:
    """Ascending cuts of each column: its distinct values but the last where they fit the bins, else approximate quantiles."""
    if not columns:
        return []
    probs = [i / max_bins for i in range(1, max_bins)]
    known = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns]
    row = df.agg(*[F.percentile_approx(x, probs, 100 * max_bins).alias(f"q{i}") for i, x in enumerate(known)],
                 *[F.max(x).alias(f"m{i}") for i, x in enumerate(known)]).first()
    return [[x for x in sorted(set(row[f"q{i}"] or [])) if x < row[f"m{i}"]] for i in range(len(columns))]


def fit_trees(df: DataFrame, numeric: list[str], codes: list[str], target: str, params: dict) -> tuple[Layout, float, list[dict]]:
    """Layout, base margin and trees fitted on ``df``: numeric columns (NULL and NaN missing), category numbers from 0, target 0 / 1.

    Both classes must be there; rows without a target are left out.
    """
    p = {**DEFAULTS, **params}
    cols = [*numeric, *codes]
    narrow = df.where(F.col(target).isNotNull()).select(
        F.xxhash64(*[F.col(c) for c in cols], target).alias("_row"), F.col(target).cast("double").alias("_y"), *[F.col(c).cast("double").alias(c) for c in cols])
    narrow = cut_lineage(narrow, "rows")
    head = narrow.agg(F.count("_y").alias("n"), F.sum("_y").alias("ones"), *[F.max(c).alias(c) for c in codes]).first()
    if not head["n"] or not 0 < head["ones"] < head["n"]:
        raise ValueError("the target must have both classes")
    layout = Layout(quantile_cuts(narrow, numeric, int(p["max_bins"])), [int(head[c] if head[c] is not None else -1) + 1 for c in codes])
    # all tasks of the gang run at once, so there are at most as many as slots
    workers = max(1, min(-(-int(head["n"]) // int(p["rows_per_task"])), df.sparkSession.sparkContext.defaultParallelism))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gang = BarrierTaskContext.get()

        def total(part: np.ndarray) -> np.ndarray:
            if workers == 1:
                return part
            said = base64.b64encode(np.ascontiguousarray(part, np.float64).tobytes()).decode()
            every = [np.frombuffer(base64.b64decode(x), np.float64) for x in gang.allGather(said)]
            return np.sum(every, axis=0).reshape(part.shape)

        rows, ys, bins = [], [], []
        for b in it:
            raw = [b.column(2 + i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(cols))]
            rows.append(b.column(0).to_numpy().astype(np.int64).view(np.uint64))
            ys.append(b.column(1).to_numpy())
            bins.append(encode(raw, layout))
        codes_ = np.concatenate(bins) if bins else np.zeros((0, len(cols)), np.int32)
        y, row = (np.concatenate(x) if x else np.zeros(0, k) for x, k in ((ys, np.float64), (rows, np.uint64)))
        # rows that repeat all columns draw apart, by how many equal ones came before
        again = pd.Series(row).groupby(row).cumcount().to_numpy(np.uint64)
        base, trees = grow(codes_, y, row + again * np.uint64(0xA0761D6478BD642F), layout, p, total)
        if gang.partitionId() == 0:
            yield pa.record_batch([pa.array([json.dumps([base, trees])])], names=["model"])

    # equal rows meet in one task, in the same order at every attempt
    dealt = narrow.repartition(workers, "_row").sortWithinPartitions("_row")
    # one row, from the first task; a limit would take single tasks out of the gang
    base, trees = json.loads(dealt.mapInArrow(run, "model string", barrier=True).collect()[0]["model"])
    return layout, base, trees


class _Shared(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric columns", TypeConverters.toListString)
    codeCols = Param(Params._dummy(), "codeCols", "columns of category numbers", TypeConverters.toListString)
    settings = Param(Params._dummy(), "settings", "learner parameters as JSON", TypeConverters.toString)


class BoostedTrees(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Spark ML estimator of :func:`fit_trees`."""

    targetCol = Param(Params._dummy(), "targetCol", "0 / 1 target", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, codeCols=None, targetCol=None, settings=None):
        super().__init__()
        self._setDefault(numericCols=[], codeCols=[], settings="{}")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "BoostedTreesModel":
        numeric, codes, settings = (self.getOrDefault(x) for x in ("numericCols", "codeCols", "settings"))
        layout, base, trees = fit_trees(dataset, numeric, codes, self.getOrDefault("targetCol"), json.loads(settings))
        fitted = json.dumps({"cuts": layout.cuts, "sizes": layout.sizes, "base": base, "trees": trees})
        return BoostedTreesModel(numericCols=numeric, codeCols=codes, settings=settings, fitted=fitted)


class BoostedTreesModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees; adds ``probability`` (double), the positive class's."""

    fitted = Param(Params._dummy(), "fitted", "layout, base margin and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, codeCols=None, settings=None, fitted=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def parts(self) -> tuple[Layout, float, list[dict]]:
        d = json.loads(self.getOrDefault("fitted"))
        return Layout(d["cuts"], d["sizes"]), d["base"], d["trees"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("probability", self.probability())

    def probability(self) -> Column:
        layout, base, trees = self.parts()
        cols = [*self.getOrDefault("numericCols"), *self.getOrDefault("codeCols")]

        @F.pandas_udf("double")
        def score(*values: pd.Series) -> pd.Series:
            return pd.Series(1 / (1 + np.exp(-margins(trees, base, [v.to_numpy(float, na_value=np.nan) for v in values], layout))))

        return score(*[F.col(c).cast("double") for c in cols])

    def importances(self) -> np.ndarray:
        """Mean gain of each encoded feature's splits, as shares that add up to 1 (all 0 without a split)."""
        layout, _, trees = self.parts()
        gain, splits = np.zeros(layout.slots), np.zeros(layout.slots)
        for tree in trees:
            for column, at, g in zip(tree["column"], tree["at"], tree["gain"]):
                if column >= 0:
                    k = layout.slot(column, at)
                    gain[k] += g
                    splits[k] += 1
        mean = np.divide(gain, splits, out=np.zeros_like(gain), where=splits > 0)
        return mean / mean.sum() if mean.sum() > 0 else mean
