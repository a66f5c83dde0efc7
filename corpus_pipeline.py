"""Corpus pipeline: language, near-duplicates, benchmark leaks, personal data, pieces.

Each stage takes (spark, docs, sf_dir) and returns the documents that go on;
its output is written and read again as the next one's input.  All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.llm import decontaminate, language, ngram_join, pieces, pii, unigram  # noqa: E402
from quarry.llm.common import doc_key, read  # noqa: E402
from quarry.llm.queries import PIECE_MODEL  # noqa: E402
from quarry.session import cut_lineage  # noqa: E402

#: The stages learn, link and count over their whole input; DuckDB has no such model.
ORACLE_SQL = None
#: Share of the likelihood that the best language must reach.
LEAST_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; those without letters or a clear language go."""
    model = language.train(docs.select("doc_id", "text", "lang"))
    found = language.predict(docs, model)
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id; repeated rows are one.

    Documents with a null id are kept (once), as they have no smallest id."""
    linked = ngram_join.link_documents(docs)
    kept = linked.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) | F.col("component_id").isNull())
    keyed = docs.select("*", *[c.alias(a) for c, a in zip(doc_key(), ("__k1", "__k2"))])
    return (keyed.join(kept.select(F.col("_k1").alias("__k1"), F.col("_k2").alias("__k2")).distinct(), ["__k1", "__k2"], "left_semi")
            .dropDuplicates(["__k1", "__k2"]).select(*docs.columns))


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    return found.filter("n_hit = 0").select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data generalised in its text; ``n_chars`` follows."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as piece ids, with the text that they decode to."""
    table = unigram.load_pieces(PIECE_MODEL)
    coded = pieces.encode(docs, table, decoded="decoded")
    return coded.select("doc_id", "lang", "source", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids",
                        (F.col("decoded") == F.replace("text", F.lit(unigram.SPACE), F.lit(" "))).alias("exact"))


STAGES = [("language", known_language), ("near_duplicates", without_near_duplicates), ("benchmark", without_leaks),
          ("personal_data", without_personal_data), ("pieces", as_pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs, name)
    return docs
