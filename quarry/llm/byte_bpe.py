"""Byte-level BPE encoding and decoding by merge replay over distinct words.

A text is split by the tokenizer's pattern; the distinct words of a block of
documents that are not solved yet are laid out side by side as one linked
list of tokens, at first one per byte.  An inverted index holds, for each
rank, the positions of the neighbouring tokens that merge into it.  The ranks
are replayed in order: all positions of a rank merge, left to right, and only
the two pairs that a merge touches are looked up and indexed again.  A word
that is a token itself is that token.

Blocks are what a task reads, so no word is shuffled; solved words are kept
for the task's next blocks, up to ``MEMO_WORDS`` of them.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Code points whose words a task holds at once, beyond which a text is cut where words cannot cross.
BLOCK_CHARS = 500_000
#: Solved words that a task keeps.
MEMO_WORDS = 500_000
#: Symbols above which a replay holds its lists as packed arrays.
PACKED = 8_000_000
#: A single space between two characters that are none always begins a word of the pattern.
WORD_START = r"(?<=\S) (?=\S)"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, of a file with a base64 token and its rank in each line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the vocabulary lacks single bytes")
    return ranks


class Replay:
    """The merges of a vocabulary, replayed over lists of words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        # by left token, what it merges into with each right one; the last entry, -1, is no token
        pairs: dict[int, dict[int, int]] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs.setdefault(a, {})[b] = rank
        none: dict[int, int] = {}
        self.into = [pairs.get(a, none) for a in range(max(ranks.values()) + 1)] + [none]
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.of_pair = np.full((257, 257), -1, np.int64)  # 256 stands for the end of a word
        for a in range(256):
            for b in range(256):
                self.of_pair[a, b] = ranks.get(bytes([a, b]), -1)

    def solve(self, words: list[bytes]) -> list[bytes]:
        """The token ids of each word, as packed int32."""
        known = [self.ranks.get(w) for w in words]
        open_words = [w for w, r in zip(words, known) if r is None]
        solved = iter(self._replay(open_words)) if open_words else iter(())
        return [next(solved) if r is None else array("i", [r]).tobytes() for r in known]

    def _replay(self, words: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1)  # where the mark after each word stands; one more mark is in front
        n = int(ends[-1]) + 1
        symbols = np.full(n, 256, np.int64)
        inside = np.ones(n, bool)
        inside[0] = inside[ends] = False
        symbols[inside] = np.frombuffer(b"".join(words), np.uint8)
        tokens = np.append(self.of_byte, np.int32(-1))[symbols]
        held = list if n <= PACKED else lambda x: array("i", x)
        tok, nxt, prv = held(tokens.tolist()), held(range(1, n + 1)), held(range(-1, n - 1))
        index, into = self._first_index(symbols), self.into
        heap = list(index)
        heapify(heap)
        while heap:
            rank = heappop(heap)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()
            for k, i in enumerate(places):
                j = nxt[i]
                if into[tok[i]].get(tok[j]) != rank:
                    continue
                after, before = nxt[j], prv[i]
                tok[i], tok[j], nxt[i], prv[after] = rank, -1, after, i
                left, right = into[tok[before]].get(rank), into[rank].get(tok[after])
                if left is not None:
                    if left in index:
                        index[left].append(before)
                    else:
                        index[left] = [before]
                        heappush(heap, left)
                if right is not None:
                    if right in index:
                        index[right].append(i)
                    else:
                        index[right] = [i]
                        heappush(heap, right)
                if left is not None and left < rank or right is not None and right < rank:
                    # a merge of lower rank comes first; the other places of this one wait
                    index[rank] = places[k + 1:]
                    heappush(heap, rank)
                    break
        final = np.array(tok, np.int32)
        alive = final >= 0
        upto = np.cumsum(alive)[ends] * 4
        packed = final[alive].tobytes()
        return [packed[s:e] for s, e in zip([0, *upto[:-1].tolist()], upto.tolist())]

    def _first_index(self, symbols: np.ndarray) -> dict[int, list[int]]:
        made = self.of_pair[symbols[:-1], symbols[1:]]
        places = np.nonzero(made >= 0)[0]
        order = np.argsort(made[places], kind="stable")
        ranks, first = np.unique(made[places][order], return_index=True)
        return {r: p.tolist() for r, p in zip(ranks.tolist(), np.split(places[order], first[1:]))}


class Encoder:
    """Texts -> packed token ids, with a memo of solved words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.replay, self.memo = Replay(ranks), {}
        self.find, self.start = regex.compile(pattern).findall, regex.compile(WORD_START)

    def parts(self, text: str) -> Iterator[str]:
        """A text, or cuts of a long one at places where a word always begins."""
        at = 0
        while len(text) - at > BLOCK_CHARS and (m := self.start.search(text, at + BLOCK_CHARS)):
            yield text[at:m.start()]
            at = m.start()
        yield text[at:] if at else text

    def block(self, texts: list[str]) -> list[bytes]:
        words = [self.find(t) for t in texts]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        new = list(set().union(*words).difference(self.memo))
        self.memo.update(zip(new, self.replay.solve([w.encode() for w in new])))
        ids_of = self.memo.__getitem__
        return [b"".join(map(ids_of, ws)) for ws in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; together the texts are one block, unless one of them is long."""
        if all(len(t) <= BLOCK_CHARS for t in texts):
            return self.block(texts)
        return [b"".join(b"".join(self.block([p])) for p in self.parts(t)) for t in texts]


def blocks(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of stretches of about ``BLOCK_CHARS``; a longer text stands alone."""
    first, texts, size = 0, [], 0
    for row, cell in enumerate(column):
        text = cell.as_py()
        if texts and size + len(text or "") > BLOCK_CHARS:
            yield first, texts
            first, texts, size = row, [], 0
        texts.append(text)
        size += len(text or "")
    if texts:
        yield first, texts


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", out: str = "token_ids",
           decoded: str | None = None) -> DataFrame:
    """``docs`` with ``out`` (array of int): the byte-level BPE ids of the whole text.

    ``ranks`` is a vocabulary (see ``load_ranks``), bounded in size and sent
    to the tasks; ``pattern`` splits a text before the merges.  There are no
    special tokens: their strings are ordinary text.  ``decoded`` names one
    more column with the bytes that the ids decode to (see ``decode``), taken
    in the same pass.  A null text has null ids and an empty one none;
    repeated rows each get their row; columns with the new names are replaced;
    an empty table stays empty.
    """
    new = [out] + ([decoded] if decoded else [])
    src = docs.drop(*new)
    at = src.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, raw = Encoder(sent.value, pattern), {r: t for t, r in sent.value.items()}
        for b in it:
            for first, texts in blocks(b.column(at)):
                packed = encoder.encode([t or "" for t in texts])
                ends = np.cumsum([0] + [len(p) // 4 for p in packed])
                gone = pa.array([t is None for t in texts])
                cols = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)), mask=gone)]
                if decoded:
                    cols.append(pa.array([None if t is None else bytes_of(raw, memoryview(p).cast("i")) for t, p in zip(texts, packed)], pa.binary()))
                part = b.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=[*part.schema.names, *new])

    fields = [T.StructField(out, T.ArrayType(T.IntegerType()))] + [T.StructField(c, T.BinaryType()) for c in new[1:]]
    return src.mapInArrow(run, T.StructType([*src.schema.fields, *fields]))


def bytes_of(raw: dict[int, bytes], ids) -> bytes:
    return b"".join(map(raw.__getitem__, ids))


def decode(docs: DataFrame, ranks: dict[bytes, int], ids_col: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out`` (binary): the bytes of the ids; null for null, and an unknown id is an error."""
    src = docs.drop(out)
    at = src.columns.index(ids_col)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = {r: t for t, r in sent.value.items()}
        for b in it:
            back = [None if ids is None else bytes_of(raw, ids) for ids in (x.as_py() for x in b.column(at))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(back, pa.binary())], names=[*b.schema.names, out])

    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField(out, T.BinaryType())]))
