"""PII: fixed patterns plus information-theoretic sanitisation of terms that reveal what they protect.

A protected entity is the value of a pattern match.  Terms within a few words
of its mentions co-occur with it.  Over the whole corpus, a term t discloses
an entity e as far as P(e | t) = (occurrences of t at mentions of e) /
(occurrences of t anywhere); it does so by log2 P(e | t) / P(e) bits, of the
-log2 P(e) that there are to reveal.  Terms
that reach the thresholds are spans of kind ``term`` wherever they stand in a
document that mentions that entity, to be generalised like the matches
themselves.  Documents without a match have no spans.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import KEY, doc_key
from quarry.llm.spans import SPAN
from quarry.llm.words import count_tokens
from quarry.session import cut_lineage

# The fixed patterns (fixed values).  The lookbehind and possessive runs find the same matches in linear time.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone", "term")

TERM = re.compile(r"[^\W\d_]{3,}")
#: Terms looked at on either side of a mention, and the characters searched for them.
NEAR, NEAR_CHARS = 6, 120
#: Thresholds: P(e | t), bits over P(e) or the share of the -log2 P(e) bits that there are, if that is less, and mentions of e beside t.
LEAST_GIVEN, LEAST_BITS, LEAST_SHARE, LEAST_MENTIONS = 0.5, 4.0, 0.75, 3


def emails(text: str) -> list[tuple[int, int]]:
    out, last = [], 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            last = m.end()
    return out


def part_of_ip(digits: str) -> bool:
    value = digits.lstrip("0") or "0"
    return len(value) <= 3 and int(value) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns by kind as listed, then start."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(part_of_ip(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def mentions(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """For each match its entity and the terms beside it, none of which lie in a match."""
    out, starts, ends = [], [], []
    for _, a, b in sorted(spans, key=lambda s: s[1]):  # matches that overlap, as disjoint stretches
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def inside(s: int, e: int) -> bool:
        i = bisect_right(starts, e - 1) - 1
        return i >= 0 and ends[i] > s

    for (kind, start, end), entity in zip(spans, entities_of(text, spans)):
        low, high = max(0, start - NEAR_CHARS), min(len(text), end + NEAR_CHARS)
        # words that the search limits cut are left out
        left = [m for m in TERM.finditer(text, low, start) if m.start() > low or not low or not text[low - 1].isalpha()][-NEAR:]
        right = []
        for m in TERM.finditer(text, end, high):
            if m.end() == high < len(text) and text[high].isalpha():
                break
            right.append(m)
            if len(right) == NEAR:
                break
        terms = [{"term": m[0].lower(), "start": m.start(), "end": m.end()} for m in left + right if not inside(*m.span())]
        out.append({"entity": entity, "terms": terms})
    return out


def entities_of(text: str, spans: list[tuple[str, int, int]]) -> list[str]:
    return [f"{kind}:{text[start:end].lower()}" for kind, start, end in spans]


def term_spans(text: str, spans: list[tuple[int, int]], terms: set[str]) -> list[tuple[int, int]]:
    """Where the terms stand outside the matches."""
    out, at = [], 0
    for start, end in [*sorted(spans), (len(text), len(text))]:
        out += [m.span() for m in TERM.finditer(text, at, max(at, start)) if m[0].lower() in terms]
        at = max(at, end)
    return out


def generalise(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with each span (start, end, kind) written as ``[KIND]``; overlapping spans become the first's."""
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1], s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def asked_terms(found: DataFrame, strong: DataFrame) -> DataFrame:
    """``_k1 _k2, wanted``: the terms that disclose an entity of the document, from ``strong`` (entity, term)."""
    entities = found.select(*KEY, F.explode(F.array_distinct(F.col("mentions.entity"))).alias("entity"))
    return entities.join(strong, "entity").groupBy(*KEY).agg(F.collect_set("term").alias("wanted"))


def read_again(found: DataFrame, strong: DataFrame, result: Callable[[str, list, list], object], kind: pa.DataType, ddl: str) -> DataFrame:
    """``_k1 _k2, result`` of each document with a match: ``result(text, matches, places of disclosing terms)``.

    Only the texts of these documents are moved, to the terms of their entities."""
    src = found.filter(F.col("__text").isNotNull()).select(*KEY, "base", "__text").join(asked_terms(found, strong), KEY, "left")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            for base, text, wanted in zip(b.column(2), b.column(3), b.column(4)):
                spans, text, wanted = base.as_py(), text.as_py(), wanted.as_py()
                places = term_spans(text, [(s["start"], s["end"]) for s in spans], set(wanted)) if wanted else []
                out.append(result(text, spans, places))
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(out, kind)], names=[*KEY, "result"])

    # repeated rows have one key and one result
    return src.mapInArrow(run, f"_k1 long, _k2 long, result {ddl}").groupBy(*KEY).agg(F.first("result").alias("result"))


MENTION = T.StructType([T.StructField("entity", T.StringType()), T.StructField("terms", T.ArrayType(T.StructType([
    T.StructField("term", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The other columns of ``docs`` with ``_k1 _k2, base`` (spans), ``mentions``, and ``__text`` where there is a match."""
    taken = {"base", "mentions", "__text", *KEY}
    rest = [c for c in docs.columns if c != text_col and c not in taken]
    src = docs.select(*rest, *doc_key(text_col=text_col), F.col(text_col).alias("__text"))
    schema = T.StructType([*src.schema.fields[:-1], T.StructField("base", T.ArrayType(SPAN)), T.StructField("mentions", T.ArrayType(MENTION)),
                           T.StructField("__text", T.StringType())])
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    near = pa.list_(pa.struct([("entity", pa.string()), ("terms", pa.list_(pa.struct(
        [("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            base, beside, kept = [], [], []
            for t in b.column(b.num_columns - 1):
                text = t.as_py() or ""
                spans = base_spans(text)
                base.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
                beside.append(mentions(text, spans))
                kept.append(text if spans else None)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(base, span), pa.array(beside, near), pa.array(kept, pa.string())],
                                             names=[f.name for f in schema.fields])

    return src.mapInArrow(run, schema)


def disclosing(docs: DataFrame, found: DataFrame, text_col: str) -> DataFrame:
    """``entity, term``: the pairs over the thresholds, from the mentions ``found`` and the words of all texts."""
    beside = found.select(F.explode("mentions").alias("m")).select("m.entity", F.explode("m.terms.term").alias("term"))
    pairs = cut_lineage(beside.groupBy("entity", "term").agg(F.count("*").alias("both"))
                        .filter(F.col("both") >= LEAST_MENTIONS), "pairs")
    wanted = pairs.select(F.col("term").alias("token")).distinct()
    total = count_tokens(docs, lambda t: [w.lower() for w in TERM.findall(t)], text_col).join(wanted, "token")
    # P(e): mentions of e among all words beside mentions
    entities = beside.groupBy("entity").agg(F.count("*").alias("of_entity"))
    of_all = beside.count()
    revealed = F.log2(F.col("given") * F.lit(of_all) / F.col("of_entity"))
    enough = F.least(F.lit(LEAST_BITS), F.lit(LEAST_SHARE) * F.log2(F.lit(of_all) / F.col("of_entity")))
    strong = (pairs.join(total.withColumnRenamed("token", "term"), "term").join(entities, "entity")
              .withColumn("given", F.least(F.col("both") / F.col("n"), F.lit(1.0)))
              .filter((F.col("given") >= LEAST_GIVEN) & (revealed >= enough))
              .select("entity", "term"))
    return cut_lineage(strong, "disclosing")


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, with ``_k1 _k2, base, terms`` (arrays of spans).

    ``base`` has the pattern matches by kind, then start; ``terms`` the
    disclosing terms by start.  A null or empty text has none; repeated rows
    each get their row (and count as mentions each); columns with the new
    names are replaced; an empty table stays empty.
    """
    found = cut_lineage(scan(docs, text_col), "mentions")
    place = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    terms = read_again(found, disclosing(docs, found, text_col), lambda _, __, places: [dict(zip(("start", "end"), p)) for p in places],
                       place, "array<struct<start:int,end:int>>")
    spans = F.transform(F.coalesce("result", F.array().cast("array<struct<start:int,end:int>>")),
                        lambda s: F.struct(F.lit("term").alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.drop("mentions", "terms", "__text").join(terms, KEY, "left").withColumn("terms", spans).drop("result")


def sanitise(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans of ``find_pii`` generalised in the text; every row and column is kept."""
    found = cut_lineage(scan(docs.select("doc_id", text_col), text_col), "mentions")
    clean = read_again(found, disclosing(docs, found, text_col), lambda text, spans, places: generalise(
        text, [(s["start"], s["end"], s["kind"]) for s in spans] + [(*p, "term") for p in places]), pa.string(), "string")
    keyed = docs.select("*", *[c.alias(a) for c, a in zip(doc_key(text_col=text_col), ("__k1", "__k2"))])
    joined = keyed.join(clean.select(F.col("_k1").alias("__k1"), F.col("_k2").alias("__k2"), F.col("result").alias("__clean")), ["__k1", "__k2"], "left")
    return joined.withColumn(text_col, F.coalesce("__clean", text_col)).select(*docs.columns)
