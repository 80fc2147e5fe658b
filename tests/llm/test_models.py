"""Trained operators: exact parts against brute force, held-out accuracy, edge rows."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe.llm import language, neighbours, quality, toxicity
from duelframe.llm.components import connected_components
from tests.llm.conftest import EDGE_ROWS

SF = "/root/testdata/sf0.01"


# -- the conditional random field -------------------------------------------------------

def brute_marginals(em, trans):
    total, one = 0.0, np.zeros(len(em))
    for path in itertools.product((0, 1), repeat=len(em)):
        s = sum(em[i] * y for i, y in enumerate(path)) + sum(trans[a][b] for a, b in zip(path, path[1:]))
        total += math.exp(s)
        one += math.exp(s) * np.array(path)
    return one / total, math.log(total)


def test_forward_backward_enumerates_all_paths():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 9):
        em, trans = rng.normal(size=n) * 3, rng.normal(size=(2, 2))
        want, logz = brute_marginals(em, trans)
        m, z, _ = toxicity.forward_backward(em[None, :], trans, np.array([n]))
        assert np.allclose(m[0], want) and np.isclose(z[0], logz)
        for step in (2, 3, 256):
            assert np.allclose(toxicity.marginals(em, trans, np.array([0, n]), step), want)


def test_marginals_of_many_texts():
    rng = np.random.default_rng(1)
    size = np.array([0, 3, 700, 0, 1, 258, 256, 0])
    first = np.concatenate(([0], np.cumsum(size)))
    em, trans = rng.normal(size=first[-1]) * 2, rng.normal(size=(2, 2))
    got = toxicity.marginals(em, trans, first, 64)
    for a, b in zip(first, first[1:]):
        if b > a:
            want = toxicity.forward_backward(em[a:b][None, :], trans, np.array([b - a]))[0][0]
            assert np.allclose(got[a:b], want)


def toxic_corpus(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        bad = i % 5 == 0
        if bad:
            for _ in range(rng.randint(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(["vilezz", "scummo", "grotzer"]) + rng.choice(["", "s", "ly"]))
        rows.append((i, " ".join(text), int(bad)))
    return rows


def test_toxicity_held_out(spark, make_docs):
    rows = toxic_corpus(1500, 3)
    docs = make_docs([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    field = toxicity.fit(docs, labels, learn=F.col("doc_id") % 4 != 0)
    got = {r["doc_id"]: r for r in toxicity.score(docs, field).collect()}
    held = [(got[i], t, y) for i, t, y in rows if i % 4 == 0]
    assert np.mean([g["predicted"] == y for g, _, y in held]) > 0.97
    for g, t, y in held:
        assert 0 <= g["score"] <= 1
        for a, b in zip(g["span_starts"], g["span_ends"]):
            if y:
                assert any(x in t.encode()[a:b].decode() for x in ("vilezz", "scummo", "grotzer"))


def test_toxicity_edges(spark, edge_docs, empty_docs, clashing):
    labels = spark.createDataFrame([(4, 1, None), (5, 0, None), (6, None, None), (None, 1, None)], "doc_id long, toxic int, text string")
    field = toxicity.fit(edge_docs, labels)
    rows = toxicity.score(edge_docs, field).collect()
    assert len(rows) == len(EDGE_ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(empty_docs, field).count() == 0 and toxicity.score(clashing, field).count() == len(EDGE_ROWS)
    none = toxicity.fit(edge_docs, labels.limit(0))
    assert all(r["score"] == 0.5 for r in toxicity.score(edge_docs, none).collect())


# -- quality --------------------------------------------------------------------------------

def test_votes_are_exact_cosines():
    rng = np.random.default_rng(2)
    v = rng.normal(size=(50, 6)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    y = rng.integers(0, 2, 50).astype(np.float32)
    voters = quality.Voters(np.ones(quality.TERMS, np.float32), np.zeros((quality.TERMS, 6), np.float32), v, y, np.ones(50, np.float32))
    x = v[:10] + 0.01
    for row, got in zip(x, voters.vote(x, 5)):
        sim = v @ row
        near = np.argsort(-sim)[:5]
        w = np.maximum(sim[near], 1e-6) ** 4
        assert np.isclose(got, (w * y[near]).sum() / w.sum(), atol=1e-5)


def test_votes_of_zero_vectors_and_ties_do_not_depend_on_the_order():
    rng = np.random.default_rng(3)
    v = np.repeat(np.eye(4, dtype=np.float32), 10, axis=0)
    y = (np.arange(40) % 10 < 3).astype(np.float32)
    weights = np.where(y == 1, 2.0, 0.5).astype(np.float32)
    share = (weights * y).sum() / weights.sum()
    for order in (np.arange(40), rng.permutation(40), rng.permutation(40)):
        voters = quality.Voters(np.ones(quality.TERMS, np.float32), np.zeros((quality.TERMS, 4), np.float32), v[order], y[order], weights[order])
        assert np.isclose(voters.vote(np.zeros((2, 4), np.float32)), share).all()
    # among equal cosines the first labelled rows vote
    voters = quality.Voters(np.ones(quality.TERMS, np.float32), np.zeros((quality.TERMS, 4), np.float32), v, y, weights)
    assert np.isclose(voters.vote(np.eye(4, dtype=np.float32), 3), 1.0).all()


def test_document_frequencies_cover_all(spark, make_docs):
    texts = ["abc abc", "abcd", "", None, "xyz" * 10]
    df, n = quality.document_frequencies(make_docs(list(enumerate(texts))))
    assert n == len(texts)
    rows = [quality.trigram_counts(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len(t or "")])) for t in texts]
    assert (df[:quality.BUCKETS] == (np.concatenate(rows) > 0).sum(axis=0)).all()


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    voters = quality.fit(docs, labels, learn=F.col("doc_id") % 3 != 0)
    got = quality.score(docs, voters).join(labels, "doc_id").where("doc_id % 3 = 0").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95


def test_quality_edges(spark, edge_docs, empty_docs, clashing):
    labels = spark.createDataFrame([(4, 1), (6, 0), (6, 1), (5, None)], "doc_id long, quality int")
    voters = quality.fit(edge_docs, labels)
    rows = quality.score(edge_docs, voters).collect()
    assert len(rows) == len(EDGE_ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(empty_docs, voters).count() == 0 and quality.score(clashing, voters).count() == len(EDGE_ROWS)
    none = quality.fit(empty_docs, labels.limit(0))
    assert all(r["score"] == 0.5 for r in quality.score(edge_docs, none).collect())


# -- language -----------------------------------------------------------------------------------

def test_filters_hold_their_grams():
    texts = ["the quick brown fox jumps over the lazy dog " * 3, "der schnelle braune fuchs springt über den hund " * 3]
    f = language.train(texts * 2, ["en", "de"] * 2)
    for lang, text in zip(("en", "de"), texts):
        code, _ = language.grams(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        mask = np.bitwise_and.reduce([f.planes[0][a] for a in f.slots(code)])
        assert (mask >> f.languages.index(lang) & 1).mean() > 0.9
    assert (f.false_rate < 0.05).all()


def test_language_of_one_document(spark, make_docs):
    rng = random.Random(5)
    rows = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60)), "aa") for i in range(30)]
    rare = " ".join("".join(rng.choice("qrstuvwx") for _ in range(6)) for _ in range(60))
    docs = make_docs([*rows, (100, rare, "bb")])
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, language.fit(docs)).collect()}
    assert got == {i: "aa" for i in range(30)} | {100: "bb"}


def test_filters_hold_more_grams_than_65536():
    letters = "abcdefghijklmnopqrst"
    text = " ".join(map("".join, itertools.product(letters, repeat=4)))
    f = language.train([text] * 2, ["aa"] * 2)
    code, _ = language.grams(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    mask = np.bitwise_and.reduce([f.planes[0][a] for a in f.slots(code)])
    assert len(np.unique(code)) > 1 << 16 and (mask & 1).all()


def test_more_than_eight_languages(spark, make_docs):
    rng = random.Random(4)
    rows = []
    for k in range(11):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 7)
        rows += [(k * 100 + i, " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(60)), f"l{k:02d}") for i in range(30)]
    docs = make_docs(rows)
    filters = language.fit(docs, F.col("doc_id") % 3 != 0)
    got = language.predict(docs, filters).join(docs.select("doc_id", "lang"), "doc_id").where("doc_id % 3 = 0").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.predict(docs, language.fit(docs, F.col("doc_id") % 4 != 2)).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("doc_id % 4 = 2").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def test_language_edges(spark, edge_docs, empty_docs, clashing):
    filters = language.fit(edge_docs)
    by = {}
    rows = language.predict(edge_docs, filters).collect()
    for r in rows:
        by.setdefault(r["doc_id"], r)
    assert len(rows) == len(EDGE_ROWS) and all(by[i]["lang_pred"] == "und" for i in (1, 2, 3, 11, None) if i is not None)
    assert by[9]["lang_pred"] == by[4]["lang_pred"] == "en"
    assert language.predict(empty_docs, filters).count() == 0 and language.predict(clashing, filters).count() == len(EDGE_ROWS)
    assert all(r["lang_pred"] == "und" for r in language.predict(edge_docs, language.fit(empty_docs)).collect())


# -- embeddings ------------------------------------------------------------------------------------

VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def brute_links(rows, threshold=0.95):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))
    ids = sorted(ok)
    links = {i: set() for i in ids}
    for a in ids:
        for b in ids:
            if a != b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= threshold:
                links[a].add(b)
    comp = {}
    for i in ids:
        if i not in comp:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in comp:
                    comp[x] = i
                    todo += links[x]
    return {i: (len(links[i]), comp[i], comp[i] == i) for i in ids}


@pytest.mark.parametrize("block", [512, 7])
def test_neighbours_match_brute_force(spark, block):
    rng = np.random.default_rng(6)
    rows = []
    for c in range(40):
        centre = rng.normal(size=16)
        spread = rng.choice([0.02, 0.15, 0.3])
        rows += [(len(rows) + i, (centre + rng.normal(size=16) * spread).astype(np.float32).tolist()) for i in range(int(rng.integers(1, 40)))]
    n = len(rows)
    rows += [(n + 1, None), (n + 2, [0.0] * 16), (n + 3, [float("nan")] + [1.0] * 15), (n + 4, [None] + [1.0] * 15), (n + 5, []),
             (n + 6, rows[0][1]), (n + 7, rows[0][1]), (n + 8, [1.0, 2.0]), (n + 9, [float("inf")] + [1.0] * 15)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VEC).repartition(4)
    got = {r["vec_id"]: tuple(r)[1:] for r in neighbours.near_duplicates(df, leaf=32, block=block).collect()}
    want = brute_links(rows)
    usable = [i for i, _ in rows if i in want]
    missed = [i for i in usable if got[i] != want[i]]
    assert len(missed) <= 0.02 * len(usable)
    assert sum(got[i][0] for i in usable) >= 0.98 * sum(want[i][0] for i in usable)
    assert all(got[i][0] <= want[i][0] for i in usable)
    assert all(got[i] == (0, i, True) for i, _ in rows if i not in want)


def test_neighbours_of_full_lists(spark):
    """Two tight groups, each larger than a list, that link to each other: all 60 are one component."""
    rng = np.random.default_rng(8)
    a, b = np.eye(16)[0], 0.955 * np.eye(16)[0] + math.sqrt(1 - 0.955 ** 2) * np.eye(16)[1]
    rows = [(i, ((a if i < 30 else b) + rng.normal(size=16) * 3e-4).astype(np.float32).tolist()) for i in range(60)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VEC).repartition(4)
    want = brute_links(rows)
    assert set(want.values()) == {(59, 0, True), (59, 0, False)}
    assert {r["vec_id"]: tuple(r)[1:] for r in neighbours.near_duplicates(df).collect()} == want


def rare_pairs(n, pairs):
    """``n`` unrelated vectors, of which the first ``pairs`` have one near copy each."""
    rng = np.random.default_rng(10)
    x = rng.normal(size=(n, 32))
    x = np.concatenate((x, x[:pairs] + rng.normal(size=(pairs, 32)) * 0.1))
    return [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]


def test_neighbours_reach_links_that_the_graph_misses(spark, monkeypatch):
    """A graph without any edge: the audit must see it though links are rare, and the scan must find them."""
    real = neighbours.neighbour_graph
    monkeypatch.setattr(neighbours, "neighbour_graph", lambda *a, **k: real(*a, **k).limit(0))
    for name in ("FIRST_DRAW", "MOST_DRAW"):
        monkeypatch.setattr(neighbours, name, 500, raising=False)
    rows = rare_pairs(1500, 3)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VEC).repartition(4)
    want = brute_links(rows)
    assert sum(n for n, _, _ in want.values()) == 6
    assert {r["vec_id"]: tuple(r)[1:] for r in neighbours.near_duplicates(df, rounds=0).collect()} == want


def test_full_scan_after_short_audits(spark, monkeypatch):
    """Audits of few vectors that stay short on every pass end in a scan of all."""
    real = neighbours.neighbour_graph
    monkeypatch.setattr(neighbours, "neighbour_graph", lambda *a, **k: real(*a, **k).limit(0))
    for name, value in (("FIRST_DRAW", 30), ("MOST_DRAW", 200), ("AUDIT", 2), ("PASSES", 1)):
        monkeypatch.setattr(neighbours, name, value, raising=False)
    rows = rare_pairs(200, 100)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VEC).repartition(4)
    assert {r["vec_id"]: tuple(r)[1:] for r in neighbours.near_duplicates(df, rounds=0).collect()} == brute_links(rows)


def test_trees_grow_with_the_leaves():
    assert neighbours.enough_trees(100, 128, 0.95) == neighbours.TREES
    for n in (70_000, 10_000_000, 10 ** 9):
        together = (1 - math.acos(0.95) / math.pi) ** math.ceil(math.log2(n / 128))
        assert 1 - (1 - together) ** neighbours.enough_trees(n, 128, 0.95) >= neighbours.RECALL


def test_forest_connects_what_hits_connect():
    rng = np.random.default_rng(9)
    for m in (1, 2, 9, 40):
        for share in (0.0, 0.03, 0.1, 1.0):
            hit = rng.random((m, m)) < share
            hit = (hit | hit.T) & ~np.eye(m, dtype=bool)
            joined = rng.random(m) < 0.2
            i, j = neighbours.forest(hit, joined)
            assert hit[i, j].all() and len(i) < m

            def closure(pairs):
                reach = np.eye(m, dtype=bool) | (joined[:, None] & joined[None, :]) | pairs | pairs.T
                for _ in range(7):
                    reach = reach @ reach
                return reach
            own = np.zeros((m, m), bool)
            own[i, j] = True
            assert (closure(own) == closure(hit)).all()


def test_neighbours_edges(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (3, [0.0, 1.0], None)], VEC)
    df = df.withColumns({c: F.lit("x") for c in ("id", "node", "emb", "rep", "u", "v", "sim")})
    rows = sorted(map(str, (tuple(r) for r in neighbours.near_duplicates(df).collect())))
    assert rows == sorted(map(str, [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 0, None, False), (3, 0, 3, True)]))
    assert neighbours.near_duplicates(df.limit(0)).count() == 0


def test_neighbours_of_very_large_and_very_small_vectors(spark):
    rows = [(1, [1e200, 1e200], 1), (2, [2e200, 2.000001e200], 1), (3, [1e-200, 1e-200], 1), (4, [3e-320, 0.0], 1), (5, [1.0, 0.0], 1),
            (6, [float("inf"), 1.0], 1), (7, [float("nan"), 1.0], 1), (8, [0.0, 0.0], 1), (9, [None, 1.0], 1), (10, [1e308, 1e308], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neighbours.near_duplicates(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 10: (3, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6), 7: (0, 7), 8: (0, 8), 9: (0, 9)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 50)] + [(100, 200), (300, 200), (7, 7)] + [(1000, i) for i in range(1001, 1100)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(51)) and got[300] == got[200] == 100 and all(got[i] == 1000 for i in range(1000, 1100))
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
