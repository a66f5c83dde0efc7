"""Registered queries against their SQL, and those without SQL against brute force, on whole tables."""

import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pyarrow.dataset as ds
import pytest

import __spark_entry__ as E
from helpers import assert_same
from quarry.llm import unigram
from quarry.llm.queries import ORACLE, PIECE_MODEL, QUERIES
from quarry.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def table(name):
    return ds.dataset(f"{SF}/{name}.parquet").to_table().to_pandas()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, con, key):
    assert_same(QUERIES[key](spark, SF).toPandas(), con.execute(ORACLE[key]).df())


def test_each_operator_is_registered_once():
    names = sorted(k for k in E.queries() if re.match(r"op\d+_", k))
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


def test_embeddings_match_brute_force(spark):
    got = QUERIES["op2_embeddings"](spark, SF).toPandas().set_index("vec_id").sort_index()
    t = table("embeddings").set_index("vec_id").sort_index()
    x = np.stack(t.embedding.values).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    assert (got.n_links.values == near.sum(axis=1)).all()
    lab = np.arange(len(x))
    while True:
        new = np.array([min([lab[i], *lab[near[i]]]) for i in range(len(x))])
        if (new == lab).all():
            break
        lab = new
    assert (got.component_id.values == t.index.values[lab]).all()


def test_secrets_base_matches_plain_regex(spark):
    got = QUERIES["op3_secrets"](spark, SF).toPandas().set_index("doc_id")
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for doc_id, text in zip(*[table("documents")[c] for c in ("doc_id", "text")]):
        spans = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 8]
        spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        spans.sort(key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
        assert got.base_sha256[doc_id] == sha(",".join(f"{k}:{s}:{e}" for k, s, e in spans))


def test_pii_base_matches_plain_regex(spark):
    got = QUERIES["op6_pii"](spark, SF).toPandas().set_index("doc_id")
    for doc_id, text in zip(*[table("documents")[c] for c in ("doc_id", "text")]):
        spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
                  if all(int(x) <= 255 for x in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            d = [int(c) for c in m[0] if c.isdigit()][::-1]
            if 13 <= len(d) <= 19 and sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(d)) % 10 == 0:
                spans.append(("card", *m.span()))
        spans += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
        assert got.base_sha256[doc_id] == sha(",".join(f"{k}:{s}:{e}" for k, s, e in spans))
        if not spans:
            assert got.spans[doc_id] == ""


def test_language_held_out_accuracy(spark):
    got = QUERIES["op8_language"](spark, SF).toPandas().merge(table("documents")[["doc_id", "lang"]])
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def best_by_search(chunk, pieces):
    """Viterbi by start positions, written apart from the library's."""
    score = {p: (s, i) for p, s, i in pieces.rows}
    best = {0: (0.0, [])}
    for s in range(len(chunk)):
        for e in range(s + 1, len(chunk) + 1):
            p = chunk[s:e]
            if p in score:
                x, ids = score[p][0], [score[p][1]]
            elif e == s + 1:
                x, ids = pieces.unk, [pieces.byte_ids[b] for b in p.encode()]
            else:
                continue
            if e not in best or best[s][0] + x > best[e][0]:
                best[e] = (best[s][0] + x, best[s][1] + ids)
    return best[len(chunk)][1]


def test_pieces_match_search_and_decode(spark):
    pieces = unigram.load_pieces(PIECE_MODEL)
    ids = QUERIES["op9_pieces"](spark, SF).toPandas().set_index("doc_id")
    counts = QUERIES["op5_token_count"](spark, SF).toPandas().set_index("doc_id")
    assert ids.exact.all()
    assert (counts.n_tokens == ids.n_pieces.reindex(counts.index)).all()
    solved = {}
    for doc_id, text in list(zip(*[table("documents")[c] for c in ("doc_id", "text")]))[:60]:
        want = []
        for c in unigram.chunks(text):
            if c not in solved:
                solved[c] = best_by_search(c, pieces)
            want += solved[c]
        assert list(ids.piece_ids[doc_id]) == want
