"""N-gram Jaccard join by vertical partitioning.

The global n-gram order is cut into fragments, ranges of shingle hashes.

1. From the first fragments, ``SHARE`` of the order, each document's shingles
   that occur in no other document are counted, fragment by fragment, and the
   partial counts are summed per document.  A document with more of them than
   any partner may miss cannot link and goes no further.
2. Documents of equal sets are one class.  Shingles of the classes left are
   ordered by rarity; a linking pair shares one among the first of each
   (prefix filter), and its place bounds the overlap (positional filter).
   All pairs with a shingle's least exclusive class are tested first; after
   that only pairs of different components remain to be tested.
3. For each pair, overlaps are counted in each fragment apart and summed.

No group's pairs are all emitted: a group of near copies is linked through its
pivot, and what is left is tested exactly, whatever its number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import KEY, doc_key
from quarry.llm.components import connected_components
from quarry.llm.hashing import U, hash_words, mix, text_parts
from quarry.session import cut_lineage

#: Part of the n-gram order that is looked at first, and fragments that overlaps are counted in.
SHARE, FRAGMENTS = 0.3, 4
#: Bytes of text whose shingles are passed on together.
PACK_BYTES = 16 << 20
SHARED = np.uint32(0xFFFFFFFF)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle) by document, then shingle, without repeats; and the size of each document's set."""
    words = hash_words(data, offsets, lower=True)
    n = words.lengths
    many = np.maximum(n - size + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), many)
    start = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(words.first[:-1], many)
    shingle = words.sequences(start, np.minimum(n, size)[doc])
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    return doc[new], shingle[new], np.bincount(doc[new], minlength=len(n))


def set_digests(doc: np.ndarray, shingle: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One 64-bit digest for each set, free of order."""
    sums = np.zeros(len(sizes) + 1, np.uint64)
    values = np.zeros(len(shingle) + 1, np.uint64)
    np.cumsum(mix(shingle ^ U(0x5851F42D4C957F2D)), out=values[1:])
    ends = np.cumsum(sizes)
    sums = values[ends] - values[ends - sizes]
    return mix(sums + sizes.astype(np.uint64)).view(np.int64)


def spare(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Shingles of a set that a partner may miss."""
    return sizes - -(-sizes * percent // 100)


def _fragments(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    """Packed shingles of the first fragments (by bucket), and a row of each pack's documents (bucket -1)."""
    width = U(int(SHARE * (1 << 64)) // buckets)
    id_type = pa.int64()
    doc_struct = pa.struct([("doc_id", id_type), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int64()), ("cls", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: list = []
        held_bytes = docs_held = 0

        def flush() -> pa.RecordBatch:
            nonlocal made, held, held_bytes, docs_held
            pack = (part << 32) + made
            made += 1
            idx = np.concatenate([h[0] for h in held]).astype(np.uint32)
            tok = np.concatenate([h[1] for h in held])
            rows = pa.concat_arrays([h[2] for h in held])
            held, held_bytes, docs_held = [], 0, 0
            tok, at, count = np.unique(tok, return_index=True, return_counts=True)
            idx = np.where(count > 1, SHARED, idx[at])
            bucket = np.minimum(tok // width, U(buckets - 1)).astype(np.int64)
            ids, firsts = np.unique(bucket, return_index=True)
            ends = np.append(firsts[1:], len(tok))
            # 48 bits tell shingles of one bucket apart; a rare mistake makes a shingle look shared, which is safe
            six = np.ascontiguousarray(tok).view(np.uint8).reshape(-1, 8)[:, :6]
            toks = [six[a:b].tobytes() for a, b in zip(firsts, ends)] + [None]
            idxs = [idx[a:b].tobytes() for a, b in zip(firsts, ends)] + [None]
            lists = pa.ListArray.from_arrays(pa.array([0] * (len(ids) + 1) + [len(rows)], pa.int32()), rows)
            return pa.record_batch([pa.array([*ids.tolist(), -1 - pack % buckets], pa.int32()),
                                    pa.array([pack] * (len(ids) + 1), pa.int64()), pa.array(toks, pa.binary()),
                                    pa.array(idxs, pa.binary()), lists], names=["bucket", "pack", "toks", "idxs", "docs"])

        for b in it:
            for row, rows, data, offsets in text_parts(b, 3):
                doc, shingle, sizes = shingle_sets(data, offsets, size)
                cls = set_digests(doc, shingle, sizes)
                low = shingle < width * U(buckets)
                fields = [b.column(0).slice(row, rows).cast(id_type), b.column(1).slice(row, rows), b.column(2).slice(row, rows),
                          pa.array(sizes.astype(np.int64)), pa.array(cls)]
                held.append((doc[low] + docs_held, shingle[low], pa.StructArray.from_arrays(fields, fields=list(doc_struct))))
                held_bytes += len(data)
                docs_held += rows
                if held_bytes >= PACK_BYTES:
                    yield flush()
        if held:
            yield flush()

    docs_type = "array<struct<doc_id:long,k1:long,k2:long,n:long,cls:long>>"
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *doc_key(), "text")
    return src.mapInArrow(run, f"bucket int, pack long, toks binary, idxs binary, docs {docs_type}")


def _exclusive(packed: DataFrame) -> DataFrame:
    """``pack, idxs, docs``: for each pack and bucket, the document of each shingle found nowhere else."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs, toks, idxs, owner = [], [], [], []
        for b in it:
            own = np.array([x is None for x in b.column(2).to_pylist()])
            if own.any():  # the packs' documents pass
                yield b.filter(pa.array(own)).select(["pack", "idxs", "docs"])
            for p, t, i in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if t is not None:
                    wide = np.zeros((len(t) // 6, 8), np.uint8)
                    wide[:, :6] = np.frombuffer(t, np.uint8).reshape(-1, 6)
                    toks.append(wide.view(np.uint64).ravel())
                    idxs.append(np.frombuffer(i, np.uint32))
                    owner.append(np.full(len(idxs[-1]), len(packs), np.int32))
                    packs.append(p)
        if not packs:
            return
        tok, idx, own = np.concatenate(toks), np.concatenate(idxs), np.concatenate(owner)
        del toks, idxs, owner
        _, at, count = np.unique(tok, return_index=True, return_counts=True)
        at = at[(count == 1) & (idx[at] != SHARED)]
        at = at[np.argsort(own[at], kind="stable")]
        ids, firsts = np.unique(own[at], return_index=True)
        ends = np.append(firsts[1:], len(at))
        blobs = [idx[at[a:e]].tobytes() for a, e in zip(firsts, ends)]
        yield pa.record_batch([pa.array([packs[k] for k in ids], pa.int64()), pa.array(blobs, pa.binary()),
                               pa.nulls(len(ids), packed_docs)], names=["pack", "idxs", "docs"])

    packed_docs = pa.list_(pa.struct([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int64()), ("cls", pa.int64())]))
    kept = packed.schema["docs"].dataType
    return packed.repartition("bucket").mapInArrow(run, T.StructType([
        T.StructField("pack", T.LongType()), T.StructField("idxs", T.BinaryType()), T.StructField("docs", kept)]))


def shingled_documents(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, _k1, _k2, n, cls, alive`` of every row: set size, set digest, and whether it may have a partner."""
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = _exclusive(_fragments(docs, size, buckets))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, pa.Array] = {}
        found: dict[int, list] = {}
        for b in it:
            for k, p in enumerate(b.column(0).to_pylist()):
                if b.column(2).is_valid()[k].as_py():
                    rows[p] = b.column(2)[k].values
                else:
                    found.setdefault(p, []).append(b.column(1)[k].as_py())
        for p, d in rows.items():
            n = d.field("n").to_numpy()
            own = np.bincount(np.frombuffer(b"".join(found.get(p, [])), np.uint32), minlength=len(d))
            alive = (own <= spare(n, percent)) & (n > 0)
            yield pa.record_batch([d.field("doc_id"), d.field("k1"), d.field("k2"), d.field("n"), d.field("cls"), pa.array(alive)],
                                  names=["doc_id", "_k1", "_k2", "n", "cls", "alive"])

    return counted.repartition("pack").mapInArrow(run, "doc_id long, _k1 long, _k2 long, n long, cls long, alive boolean")


def class_sets(docs: DataFrame, alive: DataFrame, size: int = 5) -> DataFrame:
    """``cls, n, set`` (sorted longs) of each class in ``alive``, from the text of one of its documents."""
    reps = alive.groupBy("cls").agg(F.min(F.struct(*KEY)).alias("k")).select("k.*")
    texts = docs.select(*doc_key(), "text").join(reps, KEY).dropDuplicates(KEY).select("text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for _, _, data, offsets in text_parts(b, 0):
                doc, shingle, sizes = shingle_sets(data, offsets, size)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                yield pa.record_batch([pa.array(set_digests(doc, shingle, sizes)), pa.array(sizes.astype(np.int64)),
                                       pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(shingle.view(np.int64)))],
                                      names=["cls", "n", "set"])

    return texts.mapInArrow(run, "cls long, n long, set array<long>").filter("n > 0")


def enough(na: Column, nb: Column, overlap: Column, percent: int) -> Column:
    """Whether an overlap of sets of the given sizes reaches the similarity."""
    return (100 + percent) * overlap >= percent * (na + nb)


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, overlap``: partial overlaps counted fragment by fragment, summed per pair."""
    def fragment(k: int) -> Column:
        return F.filter("set", lambda s: F.shiftrightunsigned(s, 62) == k)

    pieces = sets.select("cls", F.posexplode(F.array(*[fragment(k) for k in range(FRAGMENTS)])).alias("f", "piece"))
    return (pairs.withColumn("f", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))))
            .join(pieces.select(F.col("cls").alias("a"), "f", F.col("piece").alias("pa")), ["a", "f"])
            .join(pieces.select(F.col("cls").alias("b"), "f", F.col("piece").alias("pb")), ["b", "f"])
            .groupBy("a", "b", "na", "nb").agg(F.sum(F.size(F.array_intersect("pa", "pb"))).alias("overlap")))


def link_classes(sets: DataFrame, percent: int = 80) -> DataFrame:
    """``id, root`` for each class that links with another one."""
    shingles = sets.select("cls", "n", F.explode("set").alias("s"))
    common = shingles.groupBy("s").agg(F.count("*").alias("df")).filter("df > 1")
    shared = shingles.join(common, "s")
    by_class = {"n": F.first("n"), "p": F.sort_array(F.collect_list(F.struct("df", "s")))}  # a class has a set's size at most
    prefix = (shared.groupBy("cls").agg(*[c.alias(k) for k, c in by_class.items()])
              .withColumn("own", F.col("n") - F.size("p"))
              .withColumn("room", F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - F.col("own"))
              .filter("room > 0")
              .select("cls", "n", "own", F.posexplode(F.slice("p", 1, F.col("room").cast("int"))).alias("at", "x"))
              .select(F.col("x.s").alias("s"), F.struct("cls", "n", (F.col("own") + F.col("at")).alias("at"),
                                                       (F.col("own") / F.col("n")).alias("odd")).alias("x")))
    prefix = cut_lineage(prefix, "prefix")

    def tested(sides: DataFrame) -> DataFrame:
        """Pairs (x, y) that the place of their shared shingle allows, verified."""
        x, y = F.col("x"), F.col("y")
        may = enough(x["n"], y["n"], F.least(x["n"] - x["at"], y["n"] - y["at"]), percent)
        pick = lambda f, swap: F.when((x["cls"] < y["cls"]) != swap, x[f]).otherwise(y[f])
        pairs = (sides.filter((x["cls"] != y["cls"]) & may)
                 .select(pick("cls", False).alias("a"), pick("cls", True).alias("b"), pick("n", False).alias("na"), pick("n", True).alias("nb")).distinct())
        got = overlaps(cut_lineage(pairs, "pairs"), sets).filter(enough(F.col("na"), F.col("nb"), F.col("overlap"), percent))
        return cut_lineage(got.select("a", "b"), "links")

    # 1: every class with the least exclusive one of each shingle
    pivot = prefix.groupBy("s").agg(F.min(F.struct("x.odd", "x.cls", "x.n", "x.at")).alias("y"), F.count("*").alias("size")).filter("size > 1")
    links = tested(prefix.join(cut_lineage(pivot.select("s", "y"), "pivots"), "s"))
    roots = connected_components(links, "a", "b")
    # 2: what is still apart: those outside a shingle's largest component, with all its classes
    marked = prefix.select("s", "x", F.col("x.cls").alias("id")).join(roots, "id", "left").select("s", "x", F.coalesce("root", "id").alias("root"))
    marked = cut_lineage(marked, "marked")
    sizes = marked.groupBy("s", "root").agg(F.count("*").alias("size"))
    mixed = (sizes.groupBy("s").agg(F.max(F.struct("size", "root")).alias("main"), F.count("*").alias("roots"))
             .filter("roots > 1").select("s", F.col("main.root").alias("main")))
    mixed = cut_lineage(mixed, "mixed")
    apart = marked.join(mixed, "s").filter(F.col("root") != F.col("main")).select("s", F.col("x").alias("y"), F.col("root").alias("other"))
    more = tested(marked.join(cut_lineage(apart, "apart"), "s").filter(F.col("root") != F.col("other")))
    return connected_components(links.union(more), "a", "b")


def link_documents(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, _k1, _k2, n_shingles, component_id``.

    Words are those of the whole text, A-Z lower-cased; a text of fewer than
    ``size`` words is one shingle, and one without words (or null) links with
    nothing.  Two documents link when ``100 * common >= percent * union``;
    ``component_id`` is the smallest id reachable.  Repeated rows are documents
    with equal sets; a null id is never a component's id.  Other columns are
    ignored; an empty table gives no rows.
    """
    found = cut_lineage(shingled_documents(docs, size, percent), "shingled")
    sets = cut_lineage(class_sets(docs, found.filter("alive"), size), "sets")
    roots = link_classes(sets, percent)
    named = (found.filter("n > 0").select("cls", "doc_id").groupBy("cls").agg(F.min("doc_id").alias("least"))
             .join(roots.withColumnRenamed("id", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls")))
    named = cut_lineage(named, "named")
    of_root = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = cut_lineage(named.join(of_root, "root").select("cls", "component_id"), "of-class")
    return (found.join(of_class, "cls", "left")
            .select("doc_id", *KEY, F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
