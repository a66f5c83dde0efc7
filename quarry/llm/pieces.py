"""SentencePiece encoding and decoding through a relational lattice.

The chunks of the corpus (see ``unigram``) are counted over all rows.  For the
dictionary, at most ``DICT_ROWS`` of the most frequent chunks, the lattice is
a relation: substrings of bounded length are exploded, equi-joined to the
piece table, grouped by chunk, and Viterbi is folded over the sorted edges
with Spark's ``aggregate``.  The solved dictionary is bounded by that
parameter and goes to the tasks that write the documents' ids; a chunk
outside it is solved there by the same recurrence (``unigram.PieceIds``), so
that documents are encoded where they are read, without a shuffle of words.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.unigram import SPACE, PieceIds, Pieces, chunks
from quarry.llm.words import count_tokens
from quarry.session import cut_lineage

#: Bounds of the dictionary: chunks, and characters of one.
DICT_ROWS, DICT_CHARS = 200_000, 64
#: Rows whose ids a task holds at once.
PART_ROWS = 500


def piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    return spark.createDataFrame(pa.table({"piece": [p for p, _, _ in pieces.rows],
                                           "score": pa.array([s for _, s, _ in pieces.rows], pa.float64()),
                                           "id": pa.array([i for _, _, i in pieces.rows], pa.int32())}))


def solve_lattice(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word, ids``: the best segmentation of each distinct non-empty ``word``, in Spark expressions.

    Of equal paths into a position the one with the longest last piece stays;
    null and empty words are left out.
    """
    spark = words.sparkSession
    n = F.length("word")
    cuts = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda s: F.transform(
        F.sequence(s, F.least(n, s + F.lit(pieces.longest - 1))),
        lambda e: F.struct((s - 1).alias("s"), e.alias("e"), F.substring(F.col("word"), s, e - s + 1).alias("piece")))))
    subs = words.select("word").filter(n > 0).distinct().select("word", F.explode(cuts).alias("x")).select("word", "x.*")
    # the piece table has the fixed size of the vocabulary
    edges = (subs.join(F.broadcast(piece_table(spark, pieces)), "piece", "left")
             .filter(F.col("id").isNotNull() | (F.col("e") - F.col("s") == 1))
             .select("word", F.struct("e", "s", F.coalesce("score", F.lit(pieces.unk)).alias("score"),
                                      F.coalesce("id", F.lit(-1)).alias("id")).alias("edge")))
    lattice = edges.groupBy("word").agg(F.sort_array(F.collect_list("edge")).alias("edges"))

    def relax(nodes: Column, x: Column) -> Column:
        node = F.struct((F.get(nodes, x["s"])["score"] + x["score"]).alias("score"), x["s"].alias("s"), x["id"].alias("id"))
        better = node["score"] > F.element_at(nodes, -1)["score"]
        return (F.when(F.size(nodes) == x["e"], F.array_append(nodes, node))
                .when(better, F.array_append(F.slice(nodes, 1, x["e"]), node)).otherwise(nodes))

    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("s"), F.lit(0).alias("id")))
    solved = lattice.select("word", F.aggregate("edges", first, relax).alias("nodes"))

    def back(acc: Column, _: Column) -> Column:
        node = F.get("nodes", acc["at"])
        step = F.struct(node["s"].alias("at"), F.array_append(acc["path"], F.struct(node["s"].alias("s"), node["id"].alias("id"))).alias("path"))
        return F.when(acc["at"] > 0, step).otherwise(acc)

    start = F.struct(n.alias("at"), F.array().cast("array<struct<s:int,id:int>>").alias("path"))
    walked = solved.select("word", F.reverse(F.aggregate(F.sequence(F.lit(1), n), start, back)["path"]).alias("path"))

    def ids_of(p: Column) -> Column:
        char = F.substring(F.col("word"), p["s"] + 1, F.lit(1))
        octets = F.transform(F.sequence(F.lit(1), F.octet_length(char)), lambda i: F.get(
            F.lit(list(pieces.byte_ids)), F.conv(F.substring(F.hex(char), 2 * i - 1, F.lit(2)), 16, 10).cast("int")))
        return F.when(p["id"] >= 0, F.array(p["id"])).otherwise(octets)

    return walked.select("word", F.flatten(F.transform("path", ids_of)).alias("ids"))


def frequent_chunks(docs: DataFrame, text_col: str = "text", limit: int = DICT_ROWS) -> DataFrame:
    """``word``: the most frequent chunks of all texts, by a count threshold that keeps at most ``limit``."""
    counts = cut_lineage(count_tokens(docs, chunks, text_col).filter(F.length("token") <= DICT_CHARS), "chunks")
    by_count = sorted(counts.groupBy("n").agg(F.count("*").alias("words")).collect(), reverse=True)
    least, total = None, 0
    for n, words in by_count:
        total += words
        if total > limit:
            break
        least = n
    return counts.filter(F.col("n") >= least if least else F.lit(False)).select(F.col("token").alias("word"))


def raw_pieces(pieces: Pieces) -> dict[int, bytes]:
    """Piece id -> the bytes that it decodes to."""
    return ({i: p.replace(SPACE, " ").encode() for p, _, i in pieces.rows}
            | {i: bytes([b]) for b, i in enumerate(pieces.byte_ids)})


def text_of(raw: dict[int, bytes], ids: list[int]) -> str:
    return b"".join(map(raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


def encode(docs: DataFrame, pieces: Pieces, text_col: str = "text", out: str = "piece_ids", limit: int = DICT_ROWS,
           decoded: str | None = None) -> DataFrame:
    """``docs`` with ``out`` (array of int): the ids of the best segmentation of the whole text.

    ``decoded`` names one more column with the text that those ids decode to
    (see ``decode``), taken in the same pass.  A null text has null ids and an
    empty one none; repeated rows each get their row; columns with the new
    names are replaced; an empty table stays empty.
    """
    solved = solve_lattice(frequent_chunks(docs, text_col, limit), pieces).toArrow()
    known = {w: array("i", ids).tobytes() for w, ids in zip(solved["word"].to_pylist(), solved["ids"].to_pylist())}
    words = docs.sparkSession.sparkContext.broadcast(known)
    new = [out] + ([decoded] if decoded else [])
    src = docs.drop(*new)
    at = src.columns.index(text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, rest, raw = words.value, PieceIds(pieces), raw_pieces(pieces)

        def ids_of(chunk: str) -> bytes:
            return first.get(chunk) or rest[chunk]

        for b in it:
            for from_row in range(0, b.num_rows, PART_ROWS):
                part = b.slice(from_row, PART_ROWS)
                texts = part.column(at).to_pylist()
                packed = [b"".join(map(ids_of, chunks(t or ""))) for t in texts]
                ends = np.cumsum([0] + [len(p) // 4 for p in packed])
                cols = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)),
                                                 mask=pa.array([t is None for t in texts]))]
                if decoded:
                    back = [None if t is None else text_of(raw, memoryview(p).cast("i")) for t, p in zip(texts, packed)]
                    cols.append(pa.array(back, pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=[*part.schema.names, *new])

    fields = [T.StructField(out, T.ArrayType(T.IntegerType()))] + [T.StructField(c, T.StringType()) for c in new[1:]]
    return src.mapInArrow(run, T.StructType([*src.schema.fields, *fields]))


def decode(docs: DataFrame, pieces: Pieces, ids_col: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out``: the text of the ids (null for null).

    Space marks become spaces and the one before the text goes; bytes that
    are no UTF-8 become U+FFFD.  A literal U+2581 of a text comes back as a space.
    """
    src = docs.drop(out)
    at = src.columns.index(ids_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = raw_pieces(pieces)
        for b in it:
            for from_row in range(0, b.num_rows, PART_ROWS):
                part = b.slice(from_row, PART_ROWS)
                texts = [None if ids is None else text_of(raw, ids) for ids in (x.as_py() for x in part.column(at))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out])

    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField(out, T.StringType())]))
