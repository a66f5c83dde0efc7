"""Piece tables of SentencePiece models and the Viterbi count over them.

A piece table is used as a unigram model: the segmentation of a text is the
one with the highest sum of piece scores.  Ties follow the tokenizer's rule:
edges are relaxed by start position and only a strictly better path replaces
one, so of equal paths into a position the one whose last piece is longest
stays.  A character without a piece of its own is an edge that scores
``min(scores) - UNK_PENALTY`` and becomes its UTF-8 byte pieces.

Pieces never hold the space mark after another character, so a text may be
cut before every run of space marks (``CHUNK``) without changing its best
segmentation; each distinct chunk is solved once.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass

#: The space mark and the penalty of an unknown character (fixed values).
SPACE, UNK_PENALTY = "▁", 10.0
CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*")
#: Chunks that a task keeps solved.
CACHE_ROWS = 200_000


@dataclass(frozen=True)
class Pieces:
    """Pieces with scores and ids, the ids of the 256 byte pieces, and the unknown score."""

    rows: tuple[tuple[str, float, int], ...]
    byte_ids: tuple[int, ...]
    unk: float

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.rows)


def load_pieces(model_file: str) -> Pieces:
    """Read the piece table of a SentencePiece model with byte fallback."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model_file)
    rows, byte_ids = [], {}
    for i in range(m.get_piece_size()):
        if m.is_byte(i):
            byte_ids[int(m.id_to_piece(i)[1:-1], 16)] = i
        elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
            rows.append((m.id_to_piece(i), float(m.get_score(i)), i))
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte fallback")
    if any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _, _ in rows):
        raise ValueError("a piece holds a space mark after another character")
    return Pieces(tuple(rows), tuple(byte_ids[b] for b in range(256)), min(s for _, s, _ in rows) - UNK_PENALTY)


def chunks(text: str) -> list[str]:
    """The parts of a normalised text (space mark before it and for each space) that are solved apart."""
    return CHUNK.findall(SPACE + text.replace(" ", SPACE)) if text else []


def matcher(pieces: Pieces):
    """Aho-Corasick automaton over the pieces: value (characters, score, id)."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for p, s, i in pieces.rows:
        a.add_word(p, (len(p), s, i))
    a.make_automaton()
    return a


class PieceCounts(dict):
    """Chunk -> number of pieces, by count-only Viterbi over the automaton's matches."""

    def __init__(self, pieces: Pieces):
        self.find = matcher(pieces).iter
        self.single = {p for p, _, _ in pieces.rows if len(p) == 1}
        self.unk = pieces.unk

    def __missing__(self, chunk: str) -> int:
        n = len(chunk)
        ends: list[list] = [[] for _ in range(n + 1)]
        for last, (size, score, _) in self.find(chunk):  # for one end, longer matches come first
            ends[last + 1].append((size, score))
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        for e in range(1, n + 1):
            top, pieces = None, 0
            for size, score in ends[e]:
                at = best[e - size] + score
                if top is None or at > top:
                    top, pieces = at, count[e - size] + 1
            if chunk[e - 1] not in self.single:
                at = best[e - 1] + self.unk
                if top is None or at > top:
                    top, pieces = at, count[e - 1] + len(chunk[e - 1].encode())
            best[e], count[e] = top, pieces
        if len(self) >= CACHE_ROWS:
            self.clear()
        self[chunk] = count[n]
        return count[n]


class PieceIds(dict):
    """Chunk -> its piece ids (packed int32), by Viterbi with back pointers."""

    def __init__(self, pieces: Pieces):
        self.find = matcher(pieces).iter
        self.single = {p for p, _, _ in pieces.rows if len(p) == 1}
        self.unk, self.byte_ids = pieces.unk, pieces.byte_ids

    def __missing__(self, chunk: str) -> bytes:
        n = len(chunk)
        ends: list[list] = [[] for _ in range(n + 1)]
        for last, match in self.find(chunk):
            ends[last + 1].append(match)
        best, back = [0.0] * (n + 1), [None] * (n + 1)
        for e in range(1, n + 1):
            top = None
            for size, score, i in ends[e]:
                at = best[e - size] + score
                if top is None or at > top:
                    top, back[e] = at, (size, i)
            if chunk[e - 1] not in self.single:
                at = best[e - 1] + self.unk
                if top is None or at > top:
                    top, back[e] = at, (1, -1)
            best[e] = top
        ids, e = [], n
        while e:
            size, i = back[e]
            ids.extend([i] if i >= 0 else [self.byte_ids[b] for b in reversed(chunk[e - 1].encode())])
            e -= size
        if len(self) >= CACHE_ROWS:
            self.clear()
        out = self[chunk] = array("i", reversed(ids)).tobytes()
        return out
