"""Embedding near-dedup: random-hyperplane sign hashing, exact cosine, connected components.

Equal vectors are one class, hashed once.  Each of several tables hashes a
class to the signs of its products with random hyperplanes; classes that share
a bucket are compared by exact cosine.  The number of signs follows the number
of classes (buckets stay small) and the number of tables follows from the
recall asked for at the threshold.  A pair that met in an earlier table is not
counted again: every row carries its signs in all tables.

A bucket above ``BLOCK`` rows is cut into blocks and every pair of its blocks
is a task group of its own, so no task holds a large bucket and none of its
pairs is lost.  A group emits, for each of its vectors with links, their
number and one edge of a local spanning forest, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import small
from quarry.llm.components import connected_components
from quarry.session import cut_lineage

#: Rows of a bucket that one group compares, and vectors of a bucket aimed at.
BLOCK, BUCKET = 2048, 64
SEED = 7


def table_shape(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Signs in a bucket's code, and tables, for ``n`` vectors."""
    bits = min(30, max(4, round(math.log2(max(1, n) / BUCKET))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def pack(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """``id_col, packed``: the vector's bytes, null unless it can link (finite, not zero); and the type of its numbers."""
    dtype = "<f4" if isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType) else "<f8"

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            for v in b.column(1):
                x = v.as_py()
                ok = bool(x) and None not in x
                x = np.array(x, dtype) if ok else None
                out.append(x.tobytes() if ok and np.isfinite(x).all() and x.any() else None)
            yield pa.record_batch([b.column(0), pa.array(out, pa.binary())], names=[id_col, "packed"])

    src = vectors.select(id_col, vec_col)
    return src.mapInArrow(run, T.StructType([src.schema[0], T.StructField("packed", T.BinaryType())])), dtype


def group_links(x: np.ndarray, y: np.ndarray, same: bool, threshold: float, earlier: list) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into x, into y) of cosine at least ``threshold`` that no earlier table had together."""
    out_i, out_j = [], []
    cx, cy = earlier
    for a in range(0, len(x), 512):
        i, j = np.nonzero(x[a:a + 512] @ y.T >= threshold)
        i += a
        if same:
            i, j = i[i < j], j[i < j]
        if cx.shape[1] and len(i):
            for s in range(0, len(i), 100_000):
                new = ~(cx[i[s:s + 100_000]] == cy[j[s:s + 100_000]]).any(axis=1)
                out_i.append(i[s:s + 100_000][new])
                out_j.append(j[s:s + 100_000][new])
        else:
            out_i.append(i)
            out_j.append(j)
    return np.concatenate(out_i), np.concatenate(out_j)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index of each index's component under the edges (i, j)."""
    lab = np.arange(n)
    while True:
        low = np.minimum(lab[i], lab[j])
        new = lab.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, lab[i], low)
        np.minimum.at(new, lab[j], low)
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def bucket_links(rows: DataFrame, dtype: str, threshold: float) -> DataFrame:
    """``cls, n, root``: links of each class within the groups (t, dim, code, i, j), and a local forest edge."""
    keys = ["t", "dim", "code", "i", "j"]
    src = rows.select(*keys, "block", "cls", "m", "packed", "codes")

    def solve(g: list) -> pa.RecordBatch | None:
        key, cols = g[0][0], list(zip(*[r[1:] for r in g]))
        block, cls, m = np.array(cols[0]), cols[1], np.array(cols[2], np.float64)
        if len(cls) < 2:
            return None
        x = np.frombuffer(b"".join(cols[3]), dtype).astype(np.float64).reshape(len(cls), -1)
        scale = np.abs(x).max(axis=1, keepdims=True)
        x = x / scale
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        codes = np.array(cols[4], np.int32).reshape(len(cls), -1)[:, :key[0]]
        if key[3] == key[4]:
            i, j = group_links(x, x, True, threshold, [codes, codes])
        else:
            p, q = np.nonzero(block == key[3])[0], np.nonzero(block == key[4])[0]
            if not len(p) or not len(q):
                return None
            i, j = group_links(x[p], x[q], False, threshold, [codes[p], codes[q]])
            i, j = p[i], q[j]
        if not len(i):
            return None
        n = np.bincount(i, m[j], len(cls)) + np.bincount(j, m[i], len(cls))
        root = forest(len(cls), i, j)
        hit = np.nonzero(n)[0]
        return pa.record_batch([pa.array([cls[k] for k in hit], pa.string()), pa.array(n[hit].astype(np.int64)),
                                pa.array([cls[k] for k in root[hit]], pa.string())], names=["cls", "n", "root"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list = []
        for b in it:
            cols = [c.to_pylist() for c in b.columns]
            for r in zip(zip(*cols[:5]), *cols[5:]):
                if group and r[0] != group[0][0]:
                    if (out := solve(group)) is not None:
                        yield out
                    group = []
                group.append(r)
        if group and (out := solve(group)) is not None:
            yield out

    return src.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "cls string, n long, root string")


def link_embeddings(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9,
                    recall: float = 0.999) -> DataFrame:
    """One row per vector: ``id_col, n_links, component_id, kept``.

    Vectors of cosine at least ``threshold`` link; ``recall`` is the share
    found of pairs just at it (closer pairs: more).  Null, zero and non-finite
    vectors link with nothing, vectors of different length never with each
    other; such a row is its own component.  Repeated rows are vectors of
    their own that link with each other; a null id never is a component's id.
    Other columns are ignored; an empty table gives no rows.
    """
    packed, dtype = pack(vectors, id_col, vec_col)
    packed = cut_lineage(packed.withColumn("cls", F.md5("packed")), "packed")
    classes = (packed.filter(F.col("packed").isNotNull()).groupBy("cls")
               .agg(F.first("packed").alias("packed"), F.count("*").alias("m"), F.min(id_col).alias("least")))
    classes = cut_lineage(classes, "classes")
    bits, tables = table_shape(classes.count(), threshold, recall)
    width = 4 if dtype == "<f4" else 8

    def codes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits)
        for b in it:
            out = []
            for p in b.column(2):
                x = np.frombuffer(p.as_py(), dtype).astype(np.float64)
                if len(x) not in planes:
                    planes[len(x)] = np.random.default_rng([SEED, len(x)]).standard_normal((bits * tables, len(x)))
                signs = (planes[len(x)] @ (x / np.abs(x).max()) > 0).reshape(tables, bits)
                out.append((signs @ weights).tolist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.int32()))], names=[*b.schema.names, "codes"])

    signed = cut_lineage(classes.select("cls", "m", "packed").mapInArrow(
        codes, "cls string, m long, packed binary, codes array<int>"), "signs")
    dim = (F.octet_length("packed") / width).cast("int").alias("dim")
    sizes = (signed.select(dim, F.posexplode("codes").alias("t", "code")).groupBy("t", "dim", "code").agg(F.count("*").alias("size"))
             .filter(F.col("size") > BLOCK))
    sizes = cut_lineage(sizes, "sizes")
    rows = (signed.select("cls", "m", "packed", "codes", dim, F.posexplode("codes").alias("t", "code"))
            .join(small(sizes), ["t", "dim", "code"], "left")
            .withColumn("blocks", F.coalesce(F.ceil(F.col("size") / BLOCK), F.lit(1)).cast("int"))
            .withColumn("block", F.pmod(F.xxhash64("cls", "t"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))
    links = cut_lineage(bucket_links(rows, dtype, threshold), "links")
    roots = connected_components(links.select("cls", "root"), "cls", "root")
    roots = cut_lineage(classes.select("cls", "m", "least").join(roots.withColumnRenamed("id", "cls"), "cls", "left")
                        .withColumn("root", F.coalesce("root", "cls")), "roots")
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = (roots.join(least, "root").join(links.groupBy("cls").agg(F.sum("n").alias("n")), "cls", "left")
                .select("cls", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id"))
    return (packed.select(id_col, "cls").join(cut_lineage(of_class, "of-class"), "cls", "left")
            .select(id_col, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", F.col(id_col)).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))))
