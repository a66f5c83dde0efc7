"""Substring dedup with prefix-partitioned suffix trees.

Repeated windows of ``WINDOW`` words are the internal nodes of that depth in
the suffix tree of the corpus; runs of such windows are its maximal repeats.
The tree is never held whole, and its edges are fingerprints of word runs:

1. Short prefixes.  Every window holds an anchor, the ``GRAM``-word gram of
   least hash among those in it, so equal windows have equal anchors at equal
   places.  Suffixes are entered at their anchors alone and counted by the
   anchor's gram; a gram seen once has a single leaf below it and is dropped.
2. Variable length.  The windows around a gram seen again form its subtree.
   Most subtrees are small, and a whole one goes to one memory-sized group.
   A gram with more than 1/``HOT_SHARE`` of all anchors has its subtree cut by
   longer prefixes, the whole windows, over all groups.
3. In a group, windows are sorted; those met twice are internal nodes of the
   depth asked for, and neighbouring ones make a maximal repeat.

Before each shuffle a task reduces what it read: a gram or window that it saw
several times leaves it once, with its own occurrences settled, so that a
passage in a third of all documents reaches a group once for each task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.hashing import U, WordHashes, hash_words, mix, text_parts
from quarry.session import cut_lineage

WINDOW, GRAM = 35, 10
#: Bytes of text that a task reduces together.
PACK_BYTES = 16 << 20
#: Occurrences that a task has settled and passes on together.
SETTLED = 2_048
#: There are fewer grams above the 1/HOT_SHARE share than this, at any input size.
HOT_SHARE = 5_000


def keys(id_col: str = "doc_id", text_col: str = "text") -> list:
    """A 128-bit key of a document's id and text."""
    return [F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("_k"), F.xxhash64(F.lit(7), F.col(text_col)).alias("_t")]


def window_anchors(words: WordHashes, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each window: its text, first word and anchor; and the hashes of all grams."""
    n = words.lengths
    many = np.maximum(n - window + 1, 0)
    doc = np.repeat(np.arange(len(n)), many)
    start = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(words.first[:-1], many)
    total = len(words.sums) - 1
    if not len(start):
        return doc, start, start, np.zeros(0, np.uint64)
    grams = words.sequences(np.arange(total - gram + 1), gram)
    span, best, width = window - gram + 1, np.arange(len(grams)), 1

    def lower(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(grams[b] < grams[a], b, a)  # the left one of equals

    while 2 * width <= span:
        best = lower(best[:-width], best[width:])
        width *= 2
    best = best[start] if width == span else lower(best[start], best[start + span - width])
    return doc, start, best, grams


def _runs(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Where runs of consecutive windows of one text begin."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    return np.nonzero(new)[0]


def _anchors(texts: DataFrame, buckets: int, window: int, gram: int) -> DataFrame:
    """Anchors by bucket of their gram: grams with counts, keys and places; ``grams`` null where the task has settled them."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size, turn = 0, 97 * TaskContext.get().partitionId()  # from where settled rows go round the buckets

        def flush() -> pa.RecordBatch:
            nonlocal held, turn
            g, k, p = (np.concatenate([h[i] for h in held]) for i in range(3))
            held = []
            order = np.argsort(g, kind="stable")
            g, k, p = g[order], k[order], p[order]
            firsts = np.nonzero(np.append(True, g[1:] != g[:-1]))[0] if len(g) else np.zeros(0, int)
            count = np.diff(np.append(firsts, len(g)))
            again = np.repeat(count > 1, count)
            one, gk, gp = g[firsts], k[firsts], p[firsts]
            bucket = (one % U(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            one, gk, gp, count, bucket = one[by], gk[by], gp[by], count[by].astype(np.uint32), bucket[by]
            ids, cut = np.unique(bucket, return_index=True)
            cut = np.append(cut, len(bucket))
            blob = lambda x: [x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
            k, p = k[again], p[again]
            parts = range(0, len(k), SETTLED)
            none = [None] * len(parts)
            settled = [(turn + i) % buckets for i in range(len(parts))]
            turn += len(parts)
            return pa.record_batch([
                pa.array([*ids.tolist(), *settled], pa.int32()), pa.array([*blob(one), *none], pa.binary()), pa.array([*blob(count), *none], pa.binary()),
                pa.array([*blob(gk), *(k[i:i + SETTLED].tobytes() for i in parts)], pa.binary()),
                pa.array([*blob(gp), *(p[i:i + SETTLED].tobytes() for i in parts)], pa.binary())],
                names=["bucket", "grams", "counts", "keys", "places"])

        for b in it:
            key = b.column(0).to_numpy()
            for row, rows, data, offsets in text_parts(b, 1):
                words = hash_words(data, offsets, lower=False)
                doc, _, anchor, grams = window_anchors(words, window, gram)
                new = np.ones(len(doc), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                doc, anchor = doc[new], anchor[new]
                held.append((grams[anchor], key[row:row + rows][doc], (anchor - words.first[doc]).astype(np.uint32)))
                size += len(data)
                if size >= PACK_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return texts.mapInArrow(run, "bucket int, grams binary, counts binary, keys binary, places binary")


def _repeated_anchors(anchors: DataFrame) -> DataFrame:
    """``k, place`` of anchors whose gram is seen again; ``gram, n`` of every gram of many anchors."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        for b in it:
            for g, c, k, p in zip(*(b.column(i).to_pylist() for i in range(1, 5))):
                k, p = np.frombuffer(k, np.int64), np.frombuffer(p, np.uint32)
                if g is None:
                    yield rows(k, p)
                else:
                    parts.append((np.frombuffer(g, np.uint64), np.frombuffer(c, np.uint32), k, p))
        if not parts:
            return
        g, c, k, p = (np.concatenate([x[i] for x in parts]) for i in range(4))
        parts.clear()
        grams, at, = np.unique(g, return_inverse=True)
        total = np.bincount(at, c, len(grams)).astype(np.int64)
        back = (total[at] > 1) & (c == 1)
        yield rows(k[back], p[back])
        many = total >= 1000
        yield pa.record_batch([pa.nulls(many.sum(), pa.int64()), pa.nulls(many.sum(), pa.int32()),
                               pa.array(grams[many].view(np.int64)), pa.array(total[many])], names=["k", "place", "gram", "n"])
        yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.array([int(total.sum())])],
                              names=["k", "place", "gram", "n"])

    def rows(k: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(k), pa.array(p.astype(np.int32)), pa.nulls(len(k), pa.int64()), pa.nulls(len(k), pa.int64())],
                               names=["k", "place", "gram", "n"])

    return anchors.repartition("bucket").mapInArrow(run, "k long, place int, gram long, n long")


_RUN_NAMES = ["bucket", "windows", "again", "lens", "starts", "docs", "keys"]


def _windows(texts: DataFrame, hot: list[int], buckets: int, window: int, gram: int) -> DataFrame:
    """Windows of the subtrees by group: runs of window hashes; ``windows`` null where the task has settled them."""
    hot_grams = np.sort(np.array(hot, np.int64).view(np.uint64))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size, turn, docs_held = 0, 97 * TaskContext.get().partitionId(), 0

        def packed(sel: np.ndarray, doc, start, key) -> list:
            """Runs of the selected windows, with the keys of their documents."""
            d, s = doc[sel], start[sel]
            first = _runs(d, s)
            lens = np.diff(np.append(first, len(d))).astype(np.uint32)
            used, d = np.unique(d[first], return_inverse=True)
            return [lens.tobytes(), s[first].astype(np.uint32).tobytes(), d.astype(np.uint32).tobytes(), key[used].tobytes()]

        def flush() -> pa.RecordBatch:
            nonlocal held, turn, docs_held
            doc, start, win, group, key = (np.concatenate([h[i] for h in held]) for i in range(5))
            held, docs_held = [], 0
            uniq, at, count = np.unique(win, return_inverse=True, return_counts=True)
            again = count[at] > 1
            out: list = [[] for _ in _RUN_NAMES]
            once = np.nonzero(~again)[0]
            bucket = (group % U(buckets)).astype(np.int64)
            by = once[np.argsort(bucket[once], kind="stable")]  # windows stay in their order within a bucket
            ids, cut = np.unique(bucket[by], return_index=True)
            spans = dict(zip(ids.tolist(), zip(cut, np.append(cut[1:], len(by)))))
            # the first place of a window seen several times stands for it
            firsts = np.zeros(len(uniq), np.int64)
            firsts[at[::-1]] = np.arange(len(win))[::-1]
            reps = firsts[count > 1]
            rep_bucket = bucket[reps]
            rep_by = np.argsort(rep_bucket, kind="stable")
            rep_ids, rep_cut = np.unique(rep_bucket[rep_by], return_index=True)
            rep_spans = dict(zip(rep_ids.tolist(), zip(rep_cut, np.append(rep_cut[1:], len(rep_by)))))
            for b in sorted(set(spans) | set(rep_spans)):
                a, e = spans.get(b, (0, 0))
                ra, re = rep_spans.get(b, (0, 0))
                sel = by[a:e]
                for col, v in zip(out, [b, win[sel].tobytes(), win[reps[rep_by[ra:re]]].tobytes(), *packed(sel, doc, start, key)]):
                    col.append(v)
            settled = np.nonzero(again)[0]
            for i in range(0, len(settled), SETTLED):
                for col, v in zip(out, [turn % buckets, None, None, *packed(settled[i:i + SETTLED], doc, start, key)]):
                    col.append(v)
                turn += 1
            return pa.record_batch([pa.array(out[0], pa.int32()), *(pa.array(c, pa.binary()) for c in out[1:])], names=_RUN_NAMES)

        for b in it:
            key = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], axis=1)
            places = b.column(3)
            for row, rows, data, offsets in text_parts(b, 2):
                words = hash_words(data, offsets, lower=False)
                doc, start, anchor, grams = window_anchors(words, window, gram)
                marked = np.zeros(len(words.sums), bool)
                part = places.slice(row, rows)
                where = part.flatten().to_numpy()
                marked[np.repeat(words.first[:-1], pc.list_value_length(part).to_numpy()) + where] = True
                kept = marked[anchor]
                doc, start, anchor = doc[kept], start[kept], anchor[kept]
                win = words.sequences(start, window)
                group = mix(grams[anchor])
                wide = np.isin(grams[anchor], hot_grams)
                group[wide] = mix(win[wide])
                held.append((doc + docs_held, start - words.first[doc], win, group, key[row:row + rows]))
                docs_held += rows
                size += len(data)
                if size >= PACK_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return texts.mapInArrow(run, "bucket int, windows binary, again binary, lens binary, starts binary, docs binary, keys binary")


def _repeats(windows: DataFrame, window: int) -> DataFrame:
    """``_k, _t, start, end``: maximal repeats of each document (words, end exclusive)."""
    def expand(lens: bytes, starts: bytes, docs: bytes, keys: bytes) -> tuple[np.ndarray, np.ndarray]:
        n = np.frombuffer(lens, np.uint32).astype(np.int64)
        start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(np.frombuffer(starts, np.uint32).astype(np.int64), n)
        return np.frombuffer(keys, np.int64).reshape(-1, 2)[np.repeat(np.frombuffer(docs, np.uint32), n)], start

    def rows(key: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != start[:-1] + 1) | (key[1:] != key[:-1]).any(axis=1)
        first = np.nonzero(new)[0]
        last = np.append(first[1:], len(start)) - 1
        return pa.record_batch([pa.array(key[first, 0]), pa.array(key[first, 1]), pa.array(start[first].astype(np.int32)),
                                pa.array((start[last] + window).astype(np.int32))], names=["_k", "_t", "start", "end"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wins, agains, places = [], [], []
        for b in it:
            for w, a, *run_cols in zip(*(b.column(i).to_pylist() for i in range(1, 7))):
                if w is None:
                    if run_cols[0]:
                        yield rows(*expand(*run_cols))
                else:
                    wins.append(np.frombuffer(w, np.uint64))
                    agains.append(np.frombuffer(a, np.uint64))
                    places.append(run_cols)
        if not wins:
            return
        every = np.concatenate(wins + agains)
        _, at, count = np.unique(every, return_inverse=True, return_counts=True)
        node = count[at] > 1
        from_ = 0
        for w, p in zip(wins, places):
            hit = node[from_:from_ + len(w)]
            from_ += len(w)
            if hit.any():
                key, start = expand(*p)
                yield rows(key[hit], start[hit])

    return windows.repartition("bucket").mapInArrow(run, "_k long, _t long, start int, end int")


def find_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``_k, _t, spans``: for each document with repeats, (start, end) of its maximal repeats, in words."""
    spark = docs.sparkSession
    gram = min(gram, window)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(*keys(), "text")
    seen = cut_lineage(_repeated_anchors(_anchors(texts.select("_k", "text"), buckets, window, gram)), "anchors")
    total = seen.filter("k is null and gram is null").agg(F.sum("n")).first()[0] or 0
    hot = [r["gram"] for r in seen.filter(F.col("gram").isNotNull() & (F.col("n") * HOT_SHARE > total)).select("gram").collect()]
    places = seen.filter("k is not null").groupBy(F.col("k").alias("_k")).agg(F.collect_set("place").alias("places"))
    found = _repeats(_windows(texts.join(places, "_k").select("_k", "_t", "text", "places"), hot, buckets, window, gram), window)
    return found.groupBy("_k", "_t").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words, n_removed`` (long) and ``kept`` (string): kept words joined by one space.

    Words are runs of characters other than ASCII space and \\x09-\\x0D,
    unchanged.  A word goes if a window of ``window`` words over it also starts
    anywhere else, in the same document or another; windows are judged on the
    input.  A null text has no words; repeated rows are each other's repeats
    and each get their row; columns with the new names are replaced; an empty
    table stays empty.
    """
    taken = {"n_words", "n_removed", "kept"}
    spans = find_repeats(docs.select("doc_id", F.col(text_col).alias("text")), window)
    src = docs.drop(*taken)
    joined = (src.select("*", *[c.alias(a) for c, a in zip(keys(text_col=text_col), ("__k", "__t"))])
              .join(spans.select(F.col("_k").alias("__k"), F.col("_t").alias("__t"), F.col("spans").alias("__spans")), ["__k", "__t"], "left")
              .select(*src.columns, "__spans"))
    at = src.columns.index(text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            n_words, n_removed, kept = [], [], []
            for t, spans in zip(b.column(at), b.column(b.num_columns - 1)):
                words = (t.as_py() or "").encode().split()
                n_words.append(len(words))
                if spans.is_valid:
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, spans.values.field("start").to_numpy(), 1)
                    np.add.at(cover, spans.values.field("end").to_numpy(), -1)
                    words = list(compress(words, (np.cumsum(cover)[:-1] == 0).tolist()))
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                names=[*b.schema.names[:-1], "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField("n_words", T.LongType()),
                                                T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]))
