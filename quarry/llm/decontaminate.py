"""Benchmark decontamination: prefix-filtered set join of item windows with documents.

Words of an item window are ordered by their rarity in the corpus.  A window
occurs only where all its words do, so a prefix of one token, its rarest word,
is necessary: only document positions with such a word are joined.  The place
of that word in the window and the document's length bound where the window
may start, and the survivors are verified word by word in the whole document.
DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import KEY, doc_key, small
from quarry.session import cut_lineage

# Between words, before A-Z is lower-cased (fixed value).
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    """Words of a text: runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    def lower(w: Column) -> Column:
        plain = F.octet_length(w) == F.length(w)
        return F.when(plain, F.lower(w)).otherwise(F.translate(w, string.ascii_uppercase, string.ascii_lowercase))
    return F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != ""), lower)


def item_windows(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: ``win`` (words), ``items`` (ids as strings, null as '')."""
    w = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), item_words(F.col(text_col)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    wins = w.filter(F.size("w") > 0).select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, size))).alias("win"))
    return wins.groupBy("win").agg(F.collect_set("item").alias("items"))


def find_leaks(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """``docs`` with ``n_words, n_hit`` (long) and ``leaked_items`` (sorted item ids as strings).

    A window is ``size`` consecutive words of an item, or all words of a
    shorter one.  A word of a document is hit if it lies in any occurrence of
    a window.  Null or empty texts have no words and no hits; an item without
    words has no window; repeated rows each get their row; the columns named
    above and ``_k1 _k2`` are replaced if the input has them; with an empty
    benchmark nothing is hit.
    """
    words = docs.select(*doc_key(), item_words(F.col("text")).alias("w"))
    wins = cut_lineage(item_windows(items, size), "windows")
    vocab = wins.select(F.explode("win").alias("word")).distinct()

    # rarity: occurrences in the corpus of each benchmark word (words that never occur drop out);
    # outer explodes, as Spark would split a text once more to leave out empty ones; the joins drop their null
    freq = cut_lineage(words.select(F.explode_outer("w").alias("word")).join(small(vocab), "word")
                       .groupBy("word").agg(F.count("*").alias("n")), "rarity")
    placed = wins.select("win", "items", F.posexplode("win").alias("at", "word")).join(small(freq), "word", "left")
    prefix = (placed.groupBy("win").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "word")).alias("p"),
                                        F.first("items").alias("items"))
              .filter("p.n > 0")
              .select("win", "items", F.col("p.at").alias("at"), F.col("p.word").alias("word"), F.size("win").alias("len")))
    prefix = cut_lineage(prefix, "prefix")

    # necessary prefix tokens, then the positional and length bounds
    found = (words.select(*KEY, F.size("w").alias("n"), F.posexplode_outer("w").alias("pos", "word"))
             .join(small(prefix), "word")
             .filter((F.col("pos") >= F.col("at")) & (F.col("pos") - F.col("at") + F.col("len") <= F.col("n")))
             .select(*KEY, F.struct((F.col("pos") - F.col("at") + 1).alias("start"), "win", "items").alias("c"))
             .groupBy(*KEY).agg(F.collect_set("c").alias("cands")))

    # exact verification in the whole document; words are taken after the join, which moves texts alone
    taken = {"n_words", "n_hit", "leaked_items", *KEY}
    base = docs.select("*", *[c.alias(a) for c, a in zip(doc_key(), ("__k1", "__k2"))]).drop(*taken)
    joined = base.join(found.select(F.col("_k1").alias("__k1"), F.col("_k2").alias("__k2"), F.col("cands").alias("__c")),
                       ["__k1", "__k2"], "left")
    cands = F.coalesce("__c", F.array().cast("array<struct<start:int,win:array<string>,items:array<string>>>"))
    # the words are the variable of an outer lambda, so that a text is split once and not once for each candidate
    seen = F.transform(F.array(item_words(F.col("text"))), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.filter(cands, lambda c: F.slice(w, c["start"], F.size(c["win"])) == c["win"]).alias("hits")))[0]
    checked = joined.withColumn("__s", seen).withColumns({"__n": F.col("__s.n"), "__hits": F.col("__s.hits")})
    hit = F.array_distinct(F.flatten(F.transform(
        "__hits", lambda c: F.sequence(c["start"], c["start"] + F.size(c["win"]) - 1))))
    leaked = F.sort_array(F.array_distinct(F.flatten(F.transform("__hits", lambda c: c["items"]))))
    return checked.select(*[c for c in docs.columns if c not in taken], F.col("__n").alias("n_words"),
                          F.size(hit).cast("long").alias("n_hit"), leaked.alias("leaked_items"))
