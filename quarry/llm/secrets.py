"""Secret scans: fixed patterns plus dictionary-primed zstandard novelty.

The identifier dictionary is the corpus's most frequent identifiers, counted
once for each distinct text; what holds or is part of a candidate stays out of
it, however often it is copied.  A candidate is a long unbroken string with a sensitive word
shortly before it.  Its novelty is the number of bytes that it adds to the
zstandard frame of the code around it, compressed with the dictionary loaded:
what the dictionary or the surroundings already hold costs almost nothing, a
key costs most of its length.  Candidates above the ratio are reported as
spans of kind ``novel`` beside those of the fixed patterns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import small
from quarry.llm.spans import SPAN
from quarry.llm.words import count_tokens
from quarry.session import cut_lineage

# The fixed patterns and their least lengths (fixed values).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a maximal run, as `[0-9a-f]+` finds it, of 32 or more
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "novel")

IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{3,}")
SENSITIVE = re.compile(r"pass(?:word|wd|phrase)|secret|token|api[_-]?key|auth|credential|bearer|private|signature|access[_-]?key", re.I | re.A)
LEAST_CANDIDATE = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_CANDIDATE},}}")
#: Characters between the sensitive word and the start of a candidate, and of code on either side that prime the frame.
NEAR, AROUND = 40, 400
#: Bytes that a candidate must add, for each of its characters.
LEAST_RATIO = 0.5
#: Identifiers in the dictionary.
DICT_WORDS = 2_000
#: Characters of a candidate, and the marks of identifiers in long runs and in candidates (no identifier starts so).
RUN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
LONG, BESIDE = "<", "!"


def base_spans(text: str, low: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, leftmost and non-overlapping for each kind; ``low`` is the lower-cased text."""
    out = []
    if any(w in low for w in ("passw", "secret", "token", "api")):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


class Novelty:
    """Marginal compressed bytes of a string against its surroundings and the identifier dictionary."""

    def __init__(self, identifiers: list[str]):
        import zstandard

        primed = zstandard.ZstdCompressionDict("\n".join(identifiers).encode() or b"\n", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.size = lambda data, c=zstandard.ZstdCompressor(level=19, dict_data=primed, write_checksum=False): len(c.compress(data))

    def ratio(self, text: str, start: int, end: int) -> float:
        before, after = text[max(0, start - AROUND):start].encode(), text[end:end + AROUND].encode()
        inside = text[start:end].encode()
        return (self.size(before + inside + after) - self.size(before + after)) / len(inside)


def candidates(text: str, low: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the candidates soon after a sensitive word, each once; ``low`` is the lower-cased text."""
    if not any(w in low for w in ("pass", "secret", "token", "api", "auth", "cred", "bearer", "private", "signature", "access")):
        return
    done = 0
    for word in SENSITIVE.finditer(text):
        at = max(word.end(), done)
        limit = word.end() + NEAR + LEAST_CANDIDATE  # the least of a candidate that starts at the last place in reach
        for m in CANDIDATE.finditer(text, at, min(len(text), limit)):
            start, end = m.start(), m.end()
            if end == limit:  # the window cut it; take it whole
                end = CANDIDATE.match(text, start).end()
            done = max(done, end)
            yield start, end


def novel_spans(text: str, low: str, known: list[tuple[str, int, int]], novelty: Novelty) -> list[tuple[str, int, int]]:
    """Candidates soon after a sensitive word that overlap no known span and cannot be compressed."""
    return [("novel", start, end) for start, end in candidates(text, low)
            if not any(s < end and start < e for _, s, e in known) and novelty.ratio(text, start, end) >= LEAST_RATIO]


def identifiers_and_marks(text: str) -> list[str]:
    """The identifiers of a text; again behind LONG for each in a run long enough for a candidate, behind BESIDE for each that overlaps one."""
    out = IDENTIFIER.findall(text)
    for run in CANDIDATE.findall(text):
        out += [LONG + t for t in IDENTIFIER.findall(run)]
    for start, end in candidates(text, text.lower()):
        while start and text[start - 1] in RUN:  # the sensitive word may be the head of the run
            start -= 1
        out += [BESIDE + t for t in IDENTIFIER.findall(text, start, end)]
    return out


def distinct_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``text``: each non-null text of ``docs`` once; only texts that occur more than once are shuffled, and copies meet in the tasks that read them."""
    texts = docs.select(F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("__h")).filter(F.col("text").isNotNull())
    again = small(cut_lineage(texts.groupBy("__h").count().filter("count > 1").select("__h"), "copied"))
    once = texts.join(again, "__h", "left_anti")
    return once.select("text").unionByName(texts.join(again, "__h", "left_semi").dropDuplicates(["__h"]).select("text"))


def identifier_dictionary(docs: DataFrame, text_col: str = "text", words: int = DICT_WORDS) -> list[str]:
    """The most frequent identifiers of the distinct texts, rarest first (what stands last is cheapest to refer to).

    An identifier that overlaps a candidate anywhere counts only in runs too
    short for a candidate: words that candidates are made of stay, a key and
    the parts that occur in it alone do not.
    """
    counts = count_tokens(distinct_texts(docs, text_col), identifiers_and_marks)
    mark = F.substring("token", 1, 1)
    sums = counts.groupBy(F.ltrim("token", F.lit(LONG + BESIDE)).alias("token")).agg(
        *[F.sum(F.when(c, F.col("n")).otherwise(0)).alias(a) for a, c in
          (("n", ~mark.isin(LONG, BESIDE)), ("long", mark == LONG), ("beside", mark == BESIDE))])
    known = sums.select("token", F.when(F.col("beside") > 0, F.col("n") - F.col("long")).otherwise(F.col("n")).alias("n")).filter("n > 0")
    return [r["token"] for r in known.orderBy(F.desc("n"), "token").limit(words).collect()][::-1]


def find_secrets(docs: DataFrame, identifiers: list[str], text_col: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with ``out``: spans of secrets in the whole text, by start, then kind as in ``KINDS``.

    A null or empty text has none; repeated rows each get their row; a column
    named ``out`` is replaced; an empty table stays empty.  No shuffle.
    """
    src = docs.drop(out)
    at = src.columns.index(text_col)
    spans_type = T.ArrayType(SPAN)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(identifiers)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for b in it:
            rows = []
            for t in b.column(at):
                text = t.as_py() or ""
                low = text.lower()
                spans = base_spans(text, low)
                spans += novel_spans(text, low, spans, novelty)
                rows.append([dict(zip(("kind", "start", "end"), s)) for s in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, kind)], names=[*b.schema.names, out])

    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField(out, spans_type)]))
