"""Language identification by word-first backoff.

A word that was seen in training scores its log frequency in each language.
An unseen word is covered from the left by character n-grams, at each place
the longest that was seen (from ``GRAM`` characters down to one), and scores
their mean.  A document scores the sum over all words of its whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.words import count_tokens
from quarry.session import cut_lineage

WORD = re.compile(r"[^\W\d_]+")
#: Bound of the labelled sample (documents), and of the known words and n-grams of each language.
SAMPLE_DOCS, KNOWN_WORDS, KNOWN_GRAMS = 20_000, 50_000, 40_000
GRAM, SMOOTH = 4, 0.5
#: Words that a task keeps scored; words whose evidence makes the score certain.
CACHE_ROWS, CERTAIN_AT = 200_000, 10
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """Languages; rows of words and of n-grams, and the log frequencies of a row in each language."""

    langs: tuple[str, ...]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(word: str) -> list[str]:
    marked = f" {word} "
    return [marked[i:i + k] for k in range(1, GRAM + 1) for i in range(len(marked) - k + 1)]


def _table(counts: DataFrame, key: str, langs: list[str], limit: int) -> tuple[dict[str, int], np.ndarray]:
    """Smoothed log frequencies, in every language, of the ``limit`` most frequent keys of each language.

    The limit is a language's own, so one with few documents keeps its table; ties go to the key first in order."""
    by_lang = [F.sum(F.when(F.col("grp") == g, F.col("n")).otherwise(0)).alias(f"n{i}") for i, g in enumerate(langs)]
    if not langs:
        return {}, np.zeros((0, 0))
    totals = np.array(counts.agg(*by_lang).first(), float)
    place = F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("n"), key))
    kept = counts.withColumn("place", place).filter(F.col("place") <= limit).select(key).distinct()
    top = counts.join(kept, key, "left_semi").groupBy(key).agg(*by_lang).orderBy(key).toArrow()
    n = np.stack([top[f"n{i}"].to_numpy() for i in range(len(langs))], axis=1)
    return {k: i for i, k in enumerate(top[key].to_pylist())}, np.log((n + SMOOTH) / (totals + SMOOTH * max(limit, len(n))))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, known_words: int = KNOWN_WORDS, known_grams: int = KNOWN_GRAMS) -> Model:
    """Fit on the documents with a text and a language, or on about ``sample_docs`` of them by a hash of the id (of
    the text, where the id is null)."""
    labelled = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    n = labelled.count()
    share = min(1.0, sample_docs / max(1, n))
    sample = labelled.filter(F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), "text")), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    words = cut_lineage(count_tokens(sample, words_of, "text", "lang"), "words")
    langs = sorted(r["grp"] for r in words.select("grp").distinct().collect())

    def to_grams(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            counts: Counter = Counter()
            for g, w, k in zip(*(b.column(i).to_pylist() for i in range(3))):
                for x in grams_of(w):
                    counts[g, x] += k
            yield pa.record_batch([pa.array([g for g, _ in counts], pa.string()), pa.array([x for _, x in counts], pa.string()),
                                   pa.array(list(counts.values()), pa.int64())], names=["grp", "gram", "n"])

    grams = (words.select("grp", "token", "n").mapInArrow(to_grams, "grp string, gram string, n long")
             .groupBy("grp", "gram").agg(F.sum("n").alias("n")))
    return Model(tuple(langs), *_table(words, "token", langs, known_words), *_table(cut_lineage(grams, "grams"), "gram", langs, known_grams))


class WordScores:
    """Row numbers of words in a growing matrix of scores, kept to ``CACHE_ROWS`` words."""

    def __init__(self, model: Model):
        self.model, self.rows, self.used = model, {}, 0
        self.scores = np.zeros((CACHE_ROWS, len(model.langs)))

    def score(self, word: str) -> np.ndarray:
        """Known word, else the mean of the longest known n-grams from each place not yet covered."""
        known = self.model.words.get(word)
        if known is not None:
            return self.model.word_logs[known]
        marked, at, parts = f" {word} ", 0, []
        while at < len(marked):
            for k in range(min(GRAM, len(marked) - at), 0, -1):
                g = self.model.grams.get(marked[at:at + k])
                if g is not None:
                    parts.append(g)
                    break
            at += k
        return self.model.gram_logs[parts].mean(axis=0) if parts else np.zeros(len(self.model.langs))

    def total(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(self.model.langs))
        for i in range(0, len(words), CACHE_ROWS // 2):
            part = words[i:i + CACHE_ROWS // 2]
            if self.used + len(part) > CACHE_ROWS:
                new = {w for w in part if w not in self.rows}
                if self.used + len(new) > CACHE_ROWS:
                    self.rows, self.used = {}, 0
            ids = []
            for w in part:
                r = self.rows.get(w)
                if r is None:
                    r = self.rows[w] = self.used
                    self.scores[r] = self.score(w)
                    self.used += 1
                ids.append(r)
            out += self.scores[ids].sum(axis=0)
        return out


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) from the whole text alone.

    ``und`` with score 0 for a null text, one without letters, or a model
    without languages; ties go to the language first in order.  ``score`` is
    the winner's share of the likelihoods of a few average words.  Repeated
    rows each get their row; columns with the new names are replaced; an empty
    table stays empty.  No shuffle.
    """
    src = docs.drop("lang_pred", "score")
    at = src.columns.index(text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = WordScores(model)
        for b in it:
            langs, scores = [], []
            for t in b.column(at):
                words = words_of(t.as_py() or "")
                if not words or not model.langs:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                mean = scorer.total(words) / len(words)
                p = np.exp((mean - mean.max()) * min(len(words), CERTAIN_AT))
                best = int(np.argmax(mean))
                langs.append(model.langs[best])
                scores.append(float(p[best] / p.sum()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*b.schema.names, "lang_pred", "score"])

    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField("lang_pred", T.StringType()),
                                             T.StructField("score", T.DoubleType())]))
