"""Byte-level BPE, periodic runs and whitening: libraries, brute force, and edge cases."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow.dataset as ds
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import byte_bpe, periods, whitening
from quarry.llm.queries import BPE_RANKS, QUERIES

SF = "/root/testdata/sf0.001"
RANKS = byte_bpe.load_ranks(public_tokenizers.path(BPE_RANKS))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
LONG = " ".join(random.Random(1).choices(["alpha", "béta", "gamma42", "δ", "it's", "  ", "x" * 50, "<|endoftext|>"], k=150_000))
ROWS = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (3, "one"), (None, "a b " * 20), (None, None), (5, "a b " * 20), (6, LONG),
        (7, "▁ \U0001F600\U0001F468‍\U0001F469 tab\tnew\nline\u0085  \x1c"), (8, "z" * 30_000), (9, "aXbXa " * 9 + "end"), (10, "it's we'll  I'M\n\n")]
SCHEMA = "doc_id long, text string, token_ids string, decoded int, n_words string, runs int, best int, collapsed int, n int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "s", 1, "n", 2, 3, 4, 5) for i, t in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def table(name):
    return ds.dataset(f"{SF}/{name}.parquet").to_table().to_pandas()


def sha(b):
    return hashlib.sha256(b).hexdigest()


# --- byte-level BPE ---------------------------------------------------------

def test_bpe_matches_the_library_on_all_documents(spark):
    got = QUERIES["op11_byte_bpe"](spark, SF).toPandas().set_index("doc_id")
    docs = table("documents")
    assert len(got) == len(docs)
    for i, text in zip(docs.doc_id, docs.text):
        ids = LIBRARY.encode_ordinary(text or "")
        assert (got.n_tokens[i], got.ids_sha256[i]) == (len(ids), sha(" ".join(map(str, ids)).encode()))
        assert got.decoded_sha256[i] == sha((text or "").encode())


def test_bpe_edges(docs, none):
    coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded="decoded")
    assert coded.count() == len(ROWS)
    rows = coded.select("doc_id", "text", "token_ids", "decoded", "n").collect()
    want = [(i, t, None if t is None else LIBRARY.encode_ordinary(t), None if t is None else t.encode(), 5) for i, t in ROWS]
    assert sorted(map(repr, [(r[0], r[1], r[2], None if r[3] is None else bytes(r[3]), r[4]) for r in rows])) == sorted(map(repr, want))
    again = byte_bpe.decode(coded.drop("decoded"), RANKS).select("decoded", "text").collect()
    assert all((r.text is None and r.decoded is None) or bytes(r.decoded).decode() == r.text for r in again)
    assert byte_bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_cuts_long_texts_only_where_words_begin():
    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in (LONG, "z" * 700_000, ("ab  \n cd\t" * 100_000)):
        parts = list(encoder.parts(text))
        assert "".join(parts) == text
        assert np.frombuffer(encoder.encode([text])[0], np.int32).tolist() == LIBRARY.encode_ordinary(text)
    assert len(list(encoder.parts(LONG))) > 1


def test_bpe_memo_may_be_cleared(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO_WORDS", 3)
    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in ("some words here, reprioritised", "other wordings thereof", "some words here, reprioritised"):
        assert np.frombuffer(encoder.encode([text])[0], np.int32).tolist() == LIBRARY.encode_ordinary(text)


def test_bpe_lower_rank_made_by_a_merge_comes_first():
    """A vocabulary in which a merge opens one of lower rank while others of its own wait."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ccab": 256, b"cca": 257, b"ab": 258, b"cc": 259}
    replay = byte_bpe.Replay(ranks)
    library = tiktoken.Encoding("odd", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choices("abc", k=rng.randint(1, 14)))
        assert np.frombuffer(replay.solve([word.encode()])[0], np.int32).tolist() == library.encode_ordinary(word)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=30), min_size=1, max_size=5))
def test_bpe_matches_the_library_on_any_text(texts):
    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    for text, packed in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(packed, np.int32).tolist() == LIBRARY.encode_ordinary(text)


# --- periodic runs ----------------------------------------------------------

def brute_runs(words):
    """Every maximal stretch of smallest period q with length >= max(6, 4 q)."""
    n, ids, out, seen = len(words), np.unique(np.array(words, object), return_inverse=True)[1] if words else np.zeros(0, int), [], set()
    for q in range(1, n // 4 + 1):
        step = np.diff(np.concatenate([[0], ids[:-q] == ids[q:], [0]]).astype(int))
        for s, e in zip(np.nonzero(step == 1)[0].tolist(), np.nonzero(step == -1)[0].tolist()):
            length = e - s + q
            if length >= max(6, 4 * q) and (s, length) not in seen:  # q ascends: an earlier one is a smaller period
                seen.add((s, length))
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def want_of(words):
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    return runs, best, b" ".join(w for i, w in enumerate(words) if i not in gone)


def test_periods_match_brute_force_on_all_documents(spark):
    got = QUERIES["op12_periods"](spark, SF).toPandas().set_index("doc_id")
    docs, planted = table("documents"), 0
    assert len(got) == len(docs)
    for i, text in zip(docs.doc_id, docs.text):
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        runs, best, kept = want_of(words)
        planted += bool(runs) and h % 10 == 0
        r = got.loc[i]
        assert (r.n_runs, r.runs_sha256) == (len(runs), sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()))
        assert r.collapsed_sha256 == sha(kept)
        if best:
            assert (r.start, r.length, r.period, r.exponent_milli) == (*best, 1000 * best[1] // best[2])
        else:
            assert np.isnan(r.start) and np.isnan(r.exponent_milli)
    assert planted


def test_periods_edges(docs, none):
    found = periods.find_runs(docs).select("doc_id", "n_words", "runs", "best", "collapsed", "n").collect()
    want = []
    for i, t in ROWS:
        words = (t or "").encode().split()
        runs, best, kept = want_of(words) if len(words) < 5_000 else ([], None, None)
        want.append((i, len(words), runs, best, kept and kept.decode(), 5))
    short = [r for r in found if r.n_words < 5_000]
    assert len(found) == len(ROWS)
    assert sorted(repr((r[0], r[1], [tuple(x) for x in r[2]], r[3] and tuple(r[3]), r[4] or None, r[5])) for r in short) == sorted(
        repr((*w[:4], w[4] or None, w[5])) for w in want if w[1] < 5_000)
    assert periods.find_runs(none).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 12), st.integers(1, 9))
def test_periods_match_brute_force_on_any_sequence(noise, period, times):
    words = (noise + (noise[:period] or [7]) * times + noise[::-1])
    assert [tuple(r) for r in periods.runs_of(np.array(words, int)).tolist()] == brute_runs([str(w).encode() for w in words])


def test_periods_of_a_very_long_text_take_little_time():
    import time
    began = time.perf_counter()
    n = 2_000_000
    assert periods.runs_of(np.zeros(n, int)).tolist() == [[0, n, 1]]
    tail = np.arange(n) % 70_001
    assert periods.runs_of(tail).tolist() == [[0, n, 70_001]]
    assert time.perf_counter() - began < 60


# --- whitening --------------------------------------------------------------

def check(got, x, k=8):
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    g = got.pivot(index="vec_id", columns="component", values="whitened").sort_index().values
    w = centred @ vectors / np.sqrt(values)
    assert np.abs(g - w * np.sign((g * w).sum(axis=0))).max() < 1e-8
    first = got[got.component == 1].sort_values("vec_id")
    assert first.deviation.tolist() == ((n * x - sums) ** 2).sum(axis=1).tolist() and (first.n == n).all()
    assert np.allclose(sorted(got.explained.unique())[::-1], values / np.trace(v), rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_whitening_matches_a_dense_solver(spark):
    got = QUERIES["op13_whitening"](spark, SF).toPandas()
    t = table("embeddings").sort_values("vec_id")
    check(got, np.floor(1024 * np.stack(t.embedding.values).astype(float)).astype(int) + 100_000)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string, _x int, n string").repartition(3)


def test_whitening_edges(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=10).tolist(), "c", 0, "n") for i in range(60)]
    bad = [(100, None, "c", 0, "n"), (101, [1.0] * 9 + [None], "c", 0, "n"), (102, [float("nan")] * 10, "c", 0, "n"),
           (103, [float("inf")] * 10, "c", 0, "n"), (104, [], "c", 0, "n"), (105, [1.0, 2.0], "c", 0, "n")]
    got = whitening.whiten(frame(spark, good + bad)).toPandas()
    assert set(got.vec_id) == set(range(60)) and len(got) == 480
    check(got, np.floor(1024 * np.array([r[1] for r in good], np.float32).astype(float)).astype(int) + 100_000)
    twice = whitening.whiten(frame(spark, good + [(None, good[0][1], "c", 0, "n")] * 2)).toPandas()
    assert len(twice) == 62 * 8 and (twice.n == 62).all() and twice.vec_id.isna().sum() == 16
    assert whitening.whiten(frame(spark, bad[:4])).count() == 0
    assert whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_whitening_without_variance(spark):
    same = whitening.whiten(frame(spark, [(i, [0.5, 1.5, 2.5], "c", 0, "n") for i in range(4)])).toPandas()
    assert len(same) == 12 and same.whitened.isna().all() and same.explained.isna().all() and same.identity_error.isna().all()
    assert (same.deviation == 0).all()
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 0.0], "c", 0, "n") for i in range(5)])).toPandas()
    first = line[line.component == 1]
    assert first.whitened.notna().all() and line[line.component > 1].whitened.isna().all()
    assert abs(first.explained.iloc[0] - 1) < 1e-12 and line.identity_error.iloc[0] < 1e-9


def test_deviation_that_fits_no_long_is_null():
    x = np.array([[10**9, 0], [-(10**9), 0], [1, 0]])
    n, sums = 3 * 10**4, x.sum(axis=0)
    assert whitening.deviations(x, n, sums) == [None, None, (n - 1) ** 2 + 0]


def test_inertia_counts_match_the_spectrum():
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 30):
        q = np.linalg.qr(rng.normal(size=(d, d)))[0]
        values = np.sort(rng.integers(-3, 4, d).astype(float))
        v = q @ np.diag(values) @ q.T
        for shift in np.arange(-3.5, 4.5):
            assert whitening.inertia_below((v + v.T) / 2, shift) == (values < shift).sum()
    assert whitening.inertia_below(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1  # no 1x1 pivot exists


@pytest.mark.parametrize("values", [[5, 5, 5, 1], [1e9, 1e9 - 1, 3, 3, 2], [1e6, 1, 1e-3, 0, 0], [2] * 12, list(range(40, 0, -1)),
                                    [1.0 + i * 1e-9 for i in range(9)][::-1]])
def test_leading_eigenpairs_of_close_and_repeated_values(values):
    q = np.linalg.qr(np.random.default_rng(4).normal(size=(len(values), len(values))))[0]
    v = q @ np.diag(np.array(values, float)) @ q.T
    v = (v + v.T) / 2
    found, vectors = whitening.leading_eigenpairs(v, 8)
    scale = max(values)
    assert np.allclose(found, values[:8], atol=1e-12 * scale, rtol=0)
    assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-10
    assert np.abs(v @ vectors.T - vectors.T * found).max() < 1e-11 * scale
