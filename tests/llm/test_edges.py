"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import chat, components, decontaminate, embeddings, language, ngram_join, pieces, pii, secrets, substring, token_count, unigram
from quarry.llm.queries import PIECE_MODEL

rng = random.Random(3)
VOCAB = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(900)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choices(VOCAB, k=n))


LONG = prose(60_000, 1)
PASSAGE = prose(60, 2)
#: (doc_id, text): null and empty values, repeated rows, one id with two texts, self-repeats, near copies, a long text.
ROWS = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (3, "one"), (None, prose(50, 3)), (None, None), (4, prose(50, 3)),
        (5, "x " + PASSAGE + " y"), (6, prose(40, 4) + " " + PASSAGE), (7, "a " * 80), (8, LONG), (9, LONG + " end"),
        (10, prose(200, 5)), (11, prose(200, 5) + " more"), (10, "other text of the same id"), (12, "Été ÉTÉ été   ça"), (13, "one two three four"),
        (14, "ONE two THREE four"), (15, "▁ ▁▁ \U0001F600 tab\tnew\nline"), (16, "a" * 30_000)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, cls string, spans string, score int, token string, _k1 string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", None, 0, 1, "c", "s", 2, "t", "k") for i, t in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return (t or "").encode().split()


def counted(rows):
    return sorted(rows, key=repr)


def test_substring(docs, none):
    seen = {}
    for d, (_, t) in enumerate(ROWS):
        w = words(t)
        for s in range(len(w) - 34):
            seen.setdefault(tuple(w[s:s + 35]), []).append((d, s))
    gone = {(d, s + k) for at in seen.values() if len(at) > 1 for d, s in at for k in range(35)}
    want = []
    for d, (i, t) in enumerate(ROWS):
        w = words(t)
        kept = [x for p, x in enumerate(w) if (d, p) not in gone]
        want.append((i, len(w), len(w) - len(kept), hashlib.md5(b" ".join(kept)).hexdigest()))
    got = substring.remove_repeats(docs)
    assert set(docs.columns) < set(got.columns)
    assert counted(tuple(r) for r in got.select("doc_id", "n_words", "n_removed", F.md5("kept")).collect()) == counted(want)
    assert substring.remove_repeats(none).count() == 0


def test_substring_hot_gram_takes_longer_prefixes(docs, monkeypatch):
    """The windows of a gram spread over all groups find the same repeats."""
    want = counted(substring.remove_repeats(docs).select("doc_id", "n_removed").collect())
    whole = substring._windows

    def spread(texts, hot, *rest):
        every = set()
        for _, t in ROWS:
            offsets = substring.np.array([0, len((t or "").encode())])
            data = substring.np.frombuffer((t or "").encode(), substring.np.uint8)
            grams = substring.window_anchors(substring.hash_words(data, offsets, lower=False), substring.WINDOW, substring.GRAM)[3]
            every |= set(grams.view(substring.np.int64).tolist())
        return whole(texts, sorted(every), *rest)

    monkeypatch.setattr(substring, "_windows", spread)
    assert counted(substring.remove_repeats(docs).select("doc_id", "n_removed").collect()) == want


def test_substring_repeated_rows_hold_each_place_once(spark, monkeypatch):
    """Rows that repeat id and text share one list of places and one of spans, as long as that of a single row."""
    rows = [(None, PASSAGE)] * 30 + [(1, "a " + PASSAGE), (2, prose(50, 8))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole, seen = substring._windows, []
    monkeypatch.setattr(substring, "_windows", lambda texts, *rest: seen.append(texts) or whole(texts, *rest))
    spans = [r.spans for r in substring.find_repeats(docs).collect()]
    places = [r.places for r in seen[0].select("places").collect()]
    assert len(places) >= 31 and all(len(p) == len(set(p)) for p in places)
    assert spans and all(len(s) == len(set(s)) for s in spans)
    got = counted((r.doc_id, r.n_removed) for r in substring.remove_repeats(docs).collect())
    assert got == counted([(None, 60)] * 30 + [(1, 60), (2, 0)])


def test_ngram_join(docs, none):
    sets = []
    for _, t in ROWS:
        w = [x.lower() if x.isascii() else b"".join(bytes([c + 32]) if 65 <= c <= 90 else bytes([c]) for c in x) for x in words(t)]
        sets.append({tuple(w[s:s + 5]) for s in range(max(1, len(w) - 4))} if w else set())
    lab = list(range(len(ROWS)))
    for _ in ROWS:
        for a in range(len(ROWS)):
            for b in range(len(ROWS)):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    lab[a] = lab[b] = min(lab[a], lab[b])
    want = []
    for d, (i, _) in enumerate(ROWS):
        ids = [ROWS[k][0] for k in range(len(ROWS)) if lab[k] == lab[d] and ROWS[k][0] is not None]
        want.append((i, len(sets[d]), min(ids) if ids else None))
    got = ngram_join.link_documents(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert counted(tuple(r) for r in got) == counted(want)
    assert ngram_join.link_documents(none).count() == 0


def test_ngram_join_near_copies_without_their_original(spark):
    """Copies that miss the pivot by a little are linked by the exact second round."""
    r, rows = random.Random(9), []
    for i in range(60):
        w = prose(120, 77).split()
        for _ in range(r.randint(1, 4)):
            w[r.randrange(len(w))] = f"edit{i}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(t.split()[s:s + 5]) for s in range(len(t.split()) - 4)} for _, t in rows]
    lab = list(range(60))
    for _ in range(60):
        for a in range(60):
            for b in range(60):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    lab[a] = lab[b] = min(lab[a], lab[b])
    got = ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: x.component_id for x in got} == dict(enumerate(lab))


def test_decontaminate(spark, docs, none):
    items = spark.createDataFrame([(1, PASSAGE), (2, " ".join(PASSAGE.split()[20:28])), (2, "ONE"), (3, None), (4, ""), (None, "tab new, LINE"),
                                   (5, " ".join(LONG.split()[-10:]))], "item_id long, text string")
    got = {(r.doc_id, r.text): r for r in decontaminate.find_leaks(docs, items).collect()}
    assert len(decontaminate.find_leaks(docs, items).collect()) == len(ROWS)
    assert (got[5, ROWS[8][1]].n_hit, got[5, ROWS[8][1]].leaked_items) == (60, ["1", "2"])
    assert got[6, ROWS[9][1]].n_hit == 60
    assert (got[3, "one"].n_hit, got[3, "one"].leaked_items) == (1, ["2"])
    assert got[14, "ONE two THREE four"].n_hit == 1
    assert (got[15, ROWS[19][1]].n_hit, got[15, ROWS[19][1]].leaked_items) == (3, [""])
    assert got[8, LONG].n_hit == 10 and got[8, LONG].n_words == 60_000
    assert (got[0, None].n_words, got[0, None].n_hit, got[1, ""].n_words) == (0, 0, 0)
    assert {r.n_hit for r in decontaminate.find_leaks(docs, items.limit(0)).collect()} == {0}
    assert decontaminate.find_leaks(none, items).count() == 0


@pytest.mark.parametrize("caller", ["operator", "pipeline"])
def test_decontaminate_splits_a_text_once_and_not_for_each_candidate(spark, caller):
    """Whatever columns a caller keeps, the candidates' lambda holds no text, and no pass splits a text twice."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = (corpus_pipeline.without_leaks(spark, docs, "/root/testdata/sf0.001") if caller == "pipeline" else
             decontaminate.find_leaks(docs, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2  # candidates, verification
    inner = re.findall(r"lambdafunction\(\(slice\((.{12})", plan)
    assert inner and all(x.startswith("lambda") for x in inner)


def test_embeddings(spark):
    v = [1.0, 2.0, 0.0]
    rows = [(1, v), (1, v), (2, [2.0, 4.0, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 0.0]), (6, [float("nan"), 1.0, 0.0]),
            (7, [float("inf"), 1.0, 0.0]), (8, [1.0, 2.0]), (9, [1.0, 1.9]), (None, [1.0, 2.1, 0.0]), (10, [-1.0, 0.0, 0.0]), (11, []),
            (12, [1e200, 2e200, 0.0])]
    vecs = spark.createDataFrame([(i, x, 0, 0) for i, x in rows], "vec_id long, embedding array<double>, cls int, packed int")
    got = counted(tuple(r) for r in embeddings.link_embeddings(vecs).collect())
    same = [(1, 4, 1, True), (1, 4, 1, True), (2, 4, 1, False), (None, 4, 1, False), (12, 4, 1, False)]
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 10, 11)]
    assert got == counted([*same, *alone, (8, 1, 8, True), (9, 1, 8, False)])
    assert embeddings.link_embeddings(vecs.limit(0)).count() == 0


def test_embeddings_in_blocks(spark, monkeypatch):
    r = random.Random(4)
    rows = [(i, [1.0 + r.random() / 50 for _ in range(8)]) for i in range(90)] + [(100 + i, [r.gauss(0, 1) for _ in range(8)]) for i in range(30)]
    vecs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = counted(embeddings.link_embeddings(vecs).collect())
    assert sum(x.n_links for x in whole) >= 90 * 89
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    assert counted(embeddings.link_embeddings(vecs).collect()) == whole


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (5, 5), (None, 3)]
    got = components.connected_components(spark.createDataFrame(chain, "u long, v long")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.root, set()).add(r.id)
    assert counted(groups.values()) == counted([set(range(61)), {100, 101, 102}])
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_secrets(spark, none):
    key = "q8Zr1LxT0vNw7YpKd3HsUj5E"
    rows = [(1, f"bearer {key} and more"), (2, f"nothing here {key}"), (3, None), (4, ""), (5, f"password = '{key}'"), (6, "token: short"),
            (7, "é token=abcdefgh1 " + "0" * 32), (8, "the secret " + "z" * 40), (9, "x" * 300_000)]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.find_secrets(
        spark.createDataFrame(rows, "doc_id long, text string"), ["alpha", "beta"]).collect()}
    assert got[1] == [("novel", 7, 7 + len(key))]
    assert got[2] == got[3] == got[4] == got[6] == got[8] == got[9] == []
    assert [s[0] for s in got[5]] == ["assign"]
    assert got[7] == [("assign", 2, 17), ("hex", 18, 50)]
    assert secrets.find_secrets(none, []).count() == 0
    assert secrets.identifier_dictionary(none) == []


def test_secret_in_many_copies_stays_novel(spark):
    """A key in a third of all rows, in exact and in edited copies, does not enter the dictionary; common words stay in it."""
    key, parts = "q8Zr1LxT0vNw7YpKd3HsUj5EaWc2MbQf", "hT5k-Wz3q-Lr8v-Xn2c"
    rows = [(i, f"bearer {key} and more") for i in range(200)] + [(200 + i, f"bearer {parts} for edit{i} now") for i in range(100)]
    rows += [(1000 + i, f"{prose(20, i)} connection handler connection-handler") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    known = secrets.identifier_dictionary(docs)
    assert key not in known and not {"Wz3q", "Lr8v", "Xn2c"} & set(known) and {"connection", "handler"} <= set(known)
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.find_secrets(docs, known).collect()}
    assert all(got[i] == [("novel", 7, 7 + len(key))] for i in range(200))
    assert all(got[i] == [("novel", 7, 7 + len(parts))] for i in range(200, 300))


def test_secret_in_reach_of_the_word():
    """A candidate may start up to NEAR characters after the sensitive word, whatever its length."""
    key, novelty = "q8Zr1LxT0vNw7YpKd3HsUj5EaWc2MbQf", secrets.Novelty(["alpha"])
    for gap in range(1, 60):
        text = "secret" + " " * gap + key + " and more"
        want = [("novel", 6 + gap, 6 + gap + len(key))] if gap <= secrets.NEAR else []
        assert secrets.novel_spans(text, text, [], novelty) == want, gap
    assert list(secrets.candidates("secret" + " " * 40 + key[:16], "secret")) == [(46, 62)]


def test_identifiers_count_once_for_each_text(spark):
    docs = spark.createDataFrame([(i, "copied words") for i in range(50)] + [(90, "other one here"), (91, "other two here"), (92, None)], "doc_id long, text string")
    assert secrets.identifier_dictionary(docs, words=2) == ["other", "here"]


def test_pii(spark, none):
    rows = [(i, f"Zebulon wrote to zeb@corp.example from {prose(12, i)}") for i in range(6)] + [
        (10, None), (11, ""), (12, "plain words alone"), (13, "a@b@c.de and 1.2.3.4.5 and 1.2.3.999"), (14, "4111 1111 1111 1111 or +1 (988) 555-2485"),
        (15, "Zebulon without the address"), (0, f"Zebulon wrote to zeb@corp.example from {prose(12, 0)}"), (16, "9" * 100_000 + " 1.2.3." + "9" * 6_000), (17, "0001.02.3.000255")]
    rows += [(1000 + i, f"{prose(9, i)} user{i}@host{i}.example {prose(9, i + 500)}") for i in range(200)]
    docs = spark.createDataFrame([(i, t, 1, "m") for i, t in rows], "doc_id long, text string, terms int, at string")
    got = {}
    for r in pii.find_pii(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[0]) == 2
    for i in range(6):
        assert [tuple(s) for s in got[i][0].base] == [("email", 17, 33)]
        assert ("term", 0, 7) in [tuple(s) for s in got[i][0].terms]
    for i in (10, 11, 12, 15, 16):
        assert not got[i][0].base and not got[i][0].terms
    assert [tuple(s) for s in got[13][0].base] == [("email", 2, 8), ("ip", 13, 20)]
    assert [s.kind for s in got[14][0].base] == ["card", "phone"]
    assert [tuple(s) for s in got[17][0].base] == [("ip", 0, 16)]
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[1].startswith("[TERM] wrote to [EMAIL] from") or clean[1].startswith("[TERM] [TERM]")
    assert clean[12] == "plain words alone" and clean[10] is None and clean[14] == "[CARD] or [PHONE]"
    assert pii.find_pii(none).count() == 0 and pii.sanitise(none).count() == 0


def test_pii_terms_of_a_hot_entity(spark):
    """A term that stands only beside an entity discloses it, however many of the mentions are its own."""
    hot = [(i, f"Zebulon wrote to zeb@corp.example from {prose(12, i)}") for i in range(100)]
    few = hot + [(1000 + i, f"{prose(9, i)} user{i % 5}@host.example {prose(9, i + 500)}") for i in range(200)]
    for rows in (few, hot[:5]):  # a third of the mentions; all of them
        got = {r.doc_id: [tuple(s) for s in r.terms] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert all(("term", 0, 7) in got[i] for i, _ in rows if i < 100)
    common = [(2000 + i, f"plain letters that Zebulon or others wrote to nobody {prose(12, i)}") for i in range(100)]
    got = pii.find_pii(spark.createDataFrame(few + common, "doc_id long, text string")).collect()
    assert not any(tuple(s) == ("term", 0, 7) for r in got for s in r.terms)  # half of Zebulon's places say too little of a third


def test_pii_terms_against_a_plain_recount(spark):
    """Every term span of a table with hot, rare and shared terms, recounted word by word."""
    import math
    from collections import Counter
    r = random.Random(8)
    names = [("Aurelia", "aurelia@corp.example"), ("Bartholomew", "192.168.7.9"), ("Cassiopeia", "+1 202 555 0147"), ("Demetrius", "dem@x.example")]
    texts = []
    for i in range(160):
        name, value = names[0] if i % 3 == 0 else r.choice(names)
        parts = [prose(r.randint(0, 9), i), r.choice([name, name.upper(), "someone"]), prose(r.randint(0, 3), i + 900), value, prose(r.randint(0, 30), i + 1800),
                 r.choice([name, "Aurelia", ""]), prose(5, i)]
        texts.append(" ".join(parts if i % 5 else parts[:1]))
    both, of_entity, everywhere, per_text = Counter(), Counter(), Counter(), []
    for t in texts:
        words = [(m[0].lower(), *m.span()) for m in re.finditer(r"[^\W\d_]{3,}", t)]
        everywhere.update(w for w, _, _ in words)
        spans = pii.base_spans(t)
        free = [w for w in words if not any(a < w[2] and w[1] < b for _, a, b in spans)]
        per_text.append((free, {f"{k}:{t[a:b].lower()}" for k, a, b in spans}))
        for k, a, b in spans:
            near = [w for w in words if w[2] <= a and a - w[1] <= 120][-6:] + [w for w in words if w[1] >= b and w[2] - b <= 120][:6]
            for w in near:
                if w in free:
                    both[f"{k}:{t[a:b].lower()}", w[0]] += 1
                    of_entity[f"{k}:{t[a:b].lower()}"] += 1
    of_all, strong = sum(of_entity.values()), set()
    for (e, w), n in both.items():
        given, bits = min(1.0, n / everywhere[w]), math.log2(of_all / of_entity[e])
        if n >= 3 and given >= 0.5 and math.log2(given) + bits >= min(4.0, 0.75 * bits):
            strong.add((e, w))
    assert strong
    got = {x.doc_id: [tuple(s)[1:] for s in x.terms] for x in pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, (free, entities) in enumerate(per_text):
        assert got[i] == [w[1:] for w in free if any((e, w[0]) in strong for e in entities)]


def test_pii_of_very_many_matches_in_one_text(spark):
    """Fifty thousand matches in one text take linear time, in the scan and where they are generalised."""
    import time
    text = " ".join(f"user{i}@host{i % 999}.example met 10.{i % 250}.0.{i % 200}" for i in range(25_000))
    began = time.perf_counter()
    spans = pii.base_spans(text)
    assert len(spans) == 50_000 and len(pii.mentions(text, spans)) == 50_000
    clean = pii.generalise(text, [(s, e, k) for k, s, e in spans])
    assert clean == " ".join(["[EMAIL] met [IP]"] * 25_000)
    assert pii.term_spans(text, [s[1:] for s in spans], {"met"})[0] == (len("user0@host0.example "), len("user0@host0.example met"))
    assert time.perf_counter() - began < 15


def test_pii_overlapping_spans_become_the_first_of_them():
    assert pii.generalise("0123456789", [(2, 5, "ip"), (4, 7, "card"), (6, 8, "phone"), (9, 10, "term")]) == "01[IP]8[TERM]"


def test_pii_terms_in_the_whole_text_of_a_document_with_a_mention(spark):
    """A disclosing term is found far from the mention, also where this document has none beside it."""
    rows = [(i, f"Zebulon Quimby wrote to zeb@corp.example from {prose(12, i)}") for i in range(20)]
    far = [(100, f"ZEBULON {prose(200, 3)} Zebulon Quimby {prose(200, 4)} zeb@corp.example {prose(200, 5)} Quimby end"),
           (101, f"Zebulon {prose(200, 6)} other@corp.example")]
    rows += far * 2 + [(1000 + i, f"{prose(9, i)} user{i}@host{i}.example {prose(9, i + 500)}") for i in range(60)]
    rows += [(2000 + i, prose(600, 700 + i)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(m.span() for w in ("zebulon", "quimby") for m in re.finditer(w, far[0][1], re.I))
    assert len(want) == 4
    got = [(r.doc_id, [tuple(s)[1:] for s in r.terms]) for r in pii.find_pii(docs).collect()]
    assert len(got) == len(rows)
    assert [t for i, t in got if i == 100] == [want] * 2 and [t for i, t in got if i == 101] == [[]] * 2
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "zebulon" not in clean[100].lower() and "quimby" not in clean[100].lower()


def test_language(spark, docs, none):
    rows = [(i, "the cat and the dog went out", "en") for i in range(30)] + [(100 + i, "der Hund und die Katze gehen aus", "de") for i in range(30)]
    model = language.train(spark.createDataFrame(rows + [(200, None, "fr"), (201, "x", None)], "doc_id long, text string, lang string"))
    assert model.langs == ("de", "en")
    asked = spark.createDataFrame([(1, "die Katzen"), (2, "the dogs"), (3, None), (4, "123 !"), (5, "")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(asked, model).collect()}
    assert got[1][0] == "de" and got[2][0] == "en"
    assert got[3] == got[4] == got[5] == ("und", 0.0)
    assert language.predict(docs, model).count() == len(ROWS)
    empty = language.train(none)
    assert {r.lang_pred for r in language.predict(docs, empty).collect()} == {"und"}
    assert language.predict(none, model).count() == 0


def test_pieces(docs, none):
    table = unigram.load_pieces(PIECE_MODEL)
    coded = pieces.decode(pieces.encode(docs, table, limit=50, decoded="at_once"), table)
    assert coded.filter(~F.col("at_once").eqNullSafe(F.col("decoded"))).count() == 0
    rows = coded.select("doc_id", "text", "piece_ids", "decoded").collect()
    assert len(rows) == len(ROWS)
    lattice = pieces.encode(docs, table, limit=100_000).select("doc_id", F.md5(F.array_join("piece_ids", ","))).collect()
    by_task = coded.select("doc_id", F.md5(F.array_join("piece_ids", ","))).collect()
    assert counted(lattice) == counted(by_task)  # the relational lattice and the in-task recurrence agree
    for r in rows:
        assert r.decoded == (None if r.text is None else r.text.replace("▁", " "))
        assert (r.piece_ids is None) == (r.text is None)
    counts = token_count.count_pieces(docs, table).select("doc_id", "n_tokens").collect()
    assert counted(tuple(r) for r in counts) == counted((r.doc_id, len(r.piece_ids or [])) for r in rows)
    assert pieces.encode(none, table).count() == 0 and token_count.count_pieces(none, table).count() == 0


def test_pieces_equal_the_library_as_unigram_model():
    """The same piece table in the library's own unigram model, chunk by chunk."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(open(PIECE_MODEL, "rb").read())
    proto.trainer_spec.model_type = 1
    lib = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    table = unigram.load_pieces(PIECE_MODEL)
    ids, counts = unigram.PieceIds(table), unigram.PieceCounts(table)
    r = random.Random(8)
    for _ in range(3_000):
        w = "".join(r.choices("abcdefghijklmnoprstuvwxyzéèöABT,.19", k=r.randint(1, 12)))
        if all(c in ids.single for c in w):
            assert list(memoryview(ids["▁" + w]).cast("i")) == lib.encode(w)
            assert counts["▁" + w] == len(lib.encode(w))


def test_chat(spark):
    rows = [(1, 0, "user", "a<b>[c]\\0\\\\1"), (1, 1, "user", None), (1, 2, "assistant", "</s><s>[user]x<t>"), (1, 3, "assistant", ""), (1, 3, "assistant", "z"),
            (1, 3, "assistant", "z"), (2, None, None, "r"), (2, None, None, "q"), (None, 0, "ass]istant", "\\3]")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn int, role string, text string, turns int")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(turns)).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", rows[0][3]), ("user", ""), ("assistant", "</s><s>[user]x<t>"), ("assistant", ""), ("assistant", "z"), ("assistant", "z")]
    assert got[1].loss_text == "</s><s>[user]x<t>zz"
    assert [tuple(t) for t in got[2].turns] == [("", "q"), ("", "r")]
    assert [tuple(t) for t in got[None].turns] == [("ass]istant", "\\3]")] and got[None].loss_text == ""
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_pipeline_stages(spark, none):
    rows = [(i, prose(150, i), "en" if i % 2 else "de", "s", 0) for i in range(12)]
    rows += [(20, rows[3][1] + " tail", "en", "s", 0), (21, None, "en", "s", 0), (22, "123", "en", "s", 0), (23, prose(100, 50) + " me@x.example", "en", "s", 0),
             (3, rows[3][1], "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.known_language(spark, docs, "")
    assert 21 not in [r.doc_id for r in kept.collect()] and 22 not in [r.doc_id for r in kept.collect()]
    single = sorted(r.doc_id for r in corpus_pipeline.without_near_duplicates(spark, docs, "").collect())
    assert single == [*range(12), 21, 22, 23]
    private = {r.doc_id: r for r in corpus_pipeline.without_personal_data(spark, docs, "").collect()}
    assert private[23].text.endswith(" [EMAIL]") and private[23].n_chars == len(private[23].text) and private[1].text == rows[1][1]
    five = none.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, five, "/root/testdata/sf0.001").count() == 0
