"""Registered queries of the text operators and their DuckDB SQL."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (byte_bpe, chat, decontaminate, embeddings, language, ngram_join, pieces, periods, pii, secrets, substring, token_count,
                        unigram, whitening)
from quarry.llm.common import read
from quarry.llm.spans import count_of, digest, joined

#: A SentencePiece model with byte fallback; its piece table is the vocabulary.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The public vocabulary of byte-level BPE.
BPE_RANKS = "byte_bpe_50k.tiktoken"


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages."""
    left = substring.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", digest(F.col("kept")).alias("kept_sha256"))


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors, whatever their labels."""
    found = embeddings.link_embeddings(read(spark, sf_dir, "embeddings"))
    return found.withColumn("vec_id", F.col("vec_id").cast("long")).withColumn("component_id", F.col("component_id").cast("long"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] != "novel")
    return secrets.find_secrets(docs, secrets.identifier_dictionary(docs)).select(
        "doc_id", count_of(spans, "assign").alias("n_assign"), count_of(spans, "access").alias("n_access"),
        count_of(spans, "hex").alias("n_hex"), digest(joined(base)).alias("base_sha256"), joined(spans).alias("spans"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("leaked_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("leaked_items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.count_pieces(docs, unigram.load_pieces(PIECE_MODEL)).select("doc_id", "n_tokens")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find_pii(read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [count_of(F.col("base"), k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, digest(joined(F.col("base"))).alias("base_sha256"),
                        joined(F.concat("base", "terms")).alias("spans"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by word shingles."""
    return ngram_join.link_documents(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the documents that are not held out."""
    docs = read(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = language.train(docs.filter(fold != 2).select("doc_id", "text", "lang"))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's piece ids, and whether they decode to its text."""
    table = unigram.load_pieces(PIECE_MODEL)
    coded = pieces.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), table, decoded="decoded")
    return coded.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids",
                        (F.col("decoded") == F.replace("text", F.lit(unigram.SPACE), F.lit(" "))).alias("exact"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, plus one whose texts hold control strings; read back from the output."""
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(planted)
    back = chat.read_back(chat.format_chats(rows))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
                       F.col("formatted_chars").cast("long").alias("formatted_chars"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's byte-level BPE ids, and the bytes that they decode to."""
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranks = byte_bpe.load_ranks(public_tokenizers.path(BPE_RANKS))
    coded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded="decoded")
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                        digest(F.array_join(F.col("token_ids").cast("array<string>"), " ")).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def tail_of(doc_id: object, n: int) -> np.ndarray | None:
    """Word numbers to read in a document whose tail is to repeat: a tenth of all, by a hash of the id."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g, at = h // 10, np.arange(n)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at[a:] = a + (at[a:] - a) % p
    return at


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, some with a repeating tail."""
    found = periods.find_runs(read(spark, sf_dir, "documents").select("doc_id", "text"), id_col="doc_id", reorder=tail_of)
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                  r["period"].cast("string"), F.lit("\n")))
    best = F.col("best")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
                        best["period"].alias("period"), F.expr("(1000L * best.length) div best.period").alias("exponent_milli"),
                        digest(F.array_join(line, "")).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the eight leading components of all of them."""
    found = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return found.withColumn("vec_id", F.col("vec_id").cast("long"))


QUERIES = {f.__name__: f for f in (op1_substring, op2_embeddings, op3_secrets, op4_decontaminate, op5_token_count, op6_pii, op7_ngram_join,
                                   op8_language, op9_pieces, op10_chat, op11_byte_bpe, op12_periods, op13_whitening)}

ORACLE = {
    "op1_substring": r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select doc_id, s, md5(array_to_string(list_slice(w, s, s + 34), ' ')) as h
        from (select doc_id, w, unnest(range(1, len(w) - 33)) as s from d where len(w) >= 35)),
rep as (select h from win group by h having count(*) > 1),
cov as (select distinct doc_id, unnest(range(s, s + 35)) as p from win join rep using (h)),
words as (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as p from d),
kept as (select doc_id, string_agg(x, ' ' order by p) as k, count(*) as n from words anti join cov using (doc_id, p) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(k, '')) as kept_sha256
from d left join kept using (doc_id)""",
    "op4_decontaminate": r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
wins as (select distinct item_id, least(10, len(w)) as k, array_to_string(list_slice(w, s, s + 9), ' ') as win
         from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from b where len(w) > 0)),
dw as (select doc_id, s, k, array_to_string(list_slice(w, s, s + k - 1), ' ') as win
       from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as s from d, (select distinct k from wins) where len(w) >= k)),
hits as (select doc_id, s, dw.k, item_id from dw join wins using (k, win)),
pos as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + k)) as p from hits) group by doc_id),
its as (select doc_id, count(distinct item_id) as n_items,
               string_agg(item_id::varchar, ',' order by item_id::varchar) as ids from (select distinct doc_id, item_id from hits) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join pos using (doc_id) left join its using (doc_id)""",
    "op7_ngram_join": r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(list_slice(w, i, i + 4), ' ') as s
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from c join n na on a = na.doc_id join n nb on b = nb.doc_id where 100 * c >= 80 * (na.n + nb.n - c)),
reach(id, to_id) as (select doc_id, doc_id from n union select id, b from reach join links on to_id = a)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(r.component_id, w.doc_id) as component_id
from w left join n using (doc_id) left join (select id as doc_id, min(to_id) as component_id from reach group by id) r using (doc_id)""",
    "op10_chat": r"""
with c as (select conv_id::bigint as conv_id, turn::bigint as turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o as (select *, lag(role) over (partition by conv_id order by turn, role, text) as before,
             2 * length(text) - length(translate(text, '\<[]', '')) as text_len,
             2 * length(role) - length(translate(role, '\<[]', '')) as role_len from c)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
       sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
       sum(text_len + case when before = role then 3 else 9 + role_len end)::bigint as formatted_chars
from o group by conv_id""",
}
