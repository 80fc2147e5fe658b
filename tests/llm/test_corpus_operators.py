"""Importance resampling, filter audit and SentencePiece against brute-force versions, and on the edge rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from duelframe.llm import filter_audit, importance, pieces
from tests.llm.conftest import EDGE_ROWS

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# -- importance resampling ----------------------------------------------------------

def brute_resample(docs, target, ngrams, buckets, least, share):
    def windows(text):
        w = ALNUM.findall(lower(text))
        runs = [" ".join(w[i:i + n]) for n in range(ngrams[0], ngrams[1] + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(r.encode()) % buckets for r in runs]

    raw = collections.Counter(b for _, t in docs for b in windows(t)[1])
    wanted = collections.Counter(b for t in target for b in windows(t)[1])
    s, t = sum(raw.values()), sum(wanted.values())
    rows = []
    for doc, text in docs:
        n, bs = windows(text)
        weight = sum(math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets)))) for b in bs)
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, n, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = able[:share[0] * len(able) // share[1]]
    return sorted([(*r, k + 1) for k, r in enumerate(drawn)] + [(*r, None) for r in able[len(drawn):]]
                  + [(*r, None) for r in rows if r[1] < least], key=str)


def resampled(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("ngrams,buckets,share", [((1, 1), 10_000, (10, 100)), ((1, 3), 97, (1, 2)), ((2, 2), 5, (1, 1))])
def test_resample_matches_brute_force(spark, make_docs, ngrams, buckets, share):
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdEé文ß'0") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    rows = [(k, " ".join(rng.choice(vocab) + rng.choice(["", ",", "\n", " -- ", "\x00"]) for _ in range(rng.randint(0, 40)))) for k in range(120)]
    rows += [(k + 200, rows[k % 7][1]) for k in range(40)] + [(None, rows[8][1])] * 5 + [(8, rows[8][1])] * 6
    target = [" ".join(rng.choice(vocab[:20]) for _ in range(30)) for _ in range(9)] + [None, ""]
    wanted = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(make_docs(rows, 5), wanted, ngrams=ngrams, buckets=buckets, least_words=8, share=share)
    assert resampled(got) == brute_resample(rows, target, ngrams, buckets, 8, share)


def test_window_buckets_keep_offsets_of_every_word():
    splitter = importance.Split(importance.Regex(importance.SEPARATORS), "removed")
    rng = random.Random(5)
    for _ in range(300):
        text = lower("".join(rng.choice("aZ é文😀\x00\x7f\x80-_9`{") for _ in range(rng.randint(0, 40))))
        w = ALNUM.findall(text)
        n, got = importance.window_buckets(text, splitter, (1, 2), 1 << 32)
        assert n == len(w)
        assert got.tolist() == [zlib.crc32(x.encode()) for x in w] + [zlib.crc32(f"{a} {b}".encode()) for a, b in zip(w, w[1:])]


def test_ranks_of_equal_rows(spark):
    rows = spark.createDataFrame([(1, 5)] * 3000 + [(2, 7), (3, 5)], "doc_id long, score long").repartition(7)
    got = importance.rank_rows(rows, [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 3003))
    assert {r["doc_id"]: r["rank"] for r in got if r["doc_id"] != 1} == {2: 1, 3: 3002}


def test_resample_edges(spark, edge_docs, empty_docs, clashing):
    target = spark.createDataFrame([("one two",)], "text string")
    got = resampled(importance.resample(edge_docs, target, least_words=1, share=(1, 2)))
    assert got == brute_resample(EDGE_ROWS, ["one two"], (1, 1), 10_000, 1, (1, 2))
    assert resampled(importance.resample(clashing, target, least_words=1, share=(1, 2))) == got
    assert importance.resample(empty_docs, target).collect() == []
    assert len(resampled(importance.resample(edge_docs, target.where("false")))) == len(EDGE_ROWS)


# -- filter audit -------------------------------------------------------------------

def brute_audit(rows, labels):
    """rows: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, text, _ in rows:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    failing = []
    for d, text, lang in rows:
        t = text or ""
        w = BLANK.findall(t)
        failing.append((d, lang or "", {c for c, bad in {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > least[t]}.items() if bad}))
    out = {}
    for part in {p for _, p, _ in failing}:
        own = [(d, f) for d, p, f in failing if p == part]
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            for k, c in enumerate(order):
                before = set(order[:k])
                gone = [d for d, f in own if c in f and not f & before]
                shapley[c] += len(gone)
                out[part, "".join(order), k + 1] = [
                    sum(not f & (before | {c}) for _, f in own), len(gone), sum(c in f and bool(f & before) for _, f in own),
                    sum(f == {c} for _, f in own), sum(d in good for d in gone), sum(d in toxic for d in gone)]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(shapley[order[k - 1]])
    return out


def audited(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in df.collect()}


@pytest.mark.parametrize("id_range", [16, 1 << 14])
def test_audit_matches_brute_force(spark, make_docs, id_range):
    rng = random.Random(11)
    vocab = [f"w{k}" for k in range(300)] + ["Up", "UP", "a#b", "50%"]
    rows = []
    for k in range(150):
        text = " ".join(rng.choice(vocab[:rng.choice([40, 150, 304])]) for _ in range(rng.choice([5, 150, 250, 400])))
        rows.append((k, rng.choice([None, "", text, text, text, rows[k // 2][1] if k else text]), rng.choice(["en", "de", None, ""])))
    rows += [(None, rows[20][1], "en")] * 3 + [(20, rows[20][1], "de")] * 2 + [(999, "x " * 300, "clean?")]
    fine = " ".join(f"v{k}" for k in range(250))
    rows.append((1000, fine, "fine"))
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 150, 2)] + [(20, 0, 1), (20, 1, 0), (None, 1, 1), (1000, 1, 0)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audited(filter_audit.audit(make_docs(rows, 5), known, id_range=id_range))
    assert got == brute_audit(rows, labels)
    assert got["fine", "ABCDE", 5] == [1, 0, 0, 0, 0, 0, 0]


def test_galloping_merges():
    rng = np.random.default_rng(2)
    for _ in range(200):
        lists = [np.unique(rng.integers(0, 10 ** rng.integers(1, 5), rng.integers(0, 400))) for _ in range(4)]
        block = int(rng.integers(1, 50))
        cut = list(filter_audit.aligned(lists, block))
        assert all(len(x) <= block for part in cut for x in part)
        assert [np.concatenate(x).tolist() for x in zip(*cut)] == [x.tolist() for x in lists] or not cut
        assert filter_audit.union(lists).tolist() == sorted(set().union(*(x.tolist() for x in lists)))
        assert filter_audit.difference(lists[0], lists[1]).tolist() == sorted(set(lists[0].tolist()) - set(lists[1].tolist()))
        bound = int(rng.integers(0, 1000))
        start = int(rng.integers(0, len(lists[0]) + 1))
        assert filter_audit.gallop(lists[0], start, bound) == max(start, int(np.searchsorted(lists[0], bound)))


def test_audit_of_own_filters(make_docs, spark):
    rows = [(k, f"{k % 2} {k % 3}") for k in range(60)]
    known = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(make_docs(rows), known, {"X": F.col("text").startswith("0"), "Y": F.col("text").endswith("0")}, repeats=None)
    found = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"]) for r in got.collect()}
    assert found == {("XY", 1): (30, 30, 0), ("XY", 2): (20, 10, 10), ("YX", 1): (40, 20, 0), ("YX", 2): (20, 20, 10)}


def test_audit_edges(spark, edge_docs, empty_docs, clashing):
    known = spark.createDataFrame([(1, 1, 1), (8, 1, 0)], "doc_id long, quality int, toxic int").withColumn("row", F.lit(1))
    rows = [(r[0], r[1], "en") for r in EDGE_ROWS]
    want = brute_audit(rows, [(1, 1, 1), (8, 1, 0)])
    assert audited(filter_audit.audit(edge_docs, known)) == want
    assert audited(filter_audit.audit(clashing.withColumns({c: F.lit(1) for c in ("row", "part", "before", "total", "f")}), known)) == want
    assert filter_audit.audit(empty_docs, known).collect() == []
    assert len(audited(filter_audit.audit(edge_docs, known.where("false")))) == 600


# -- SentencePiece -------------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    return pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))


def odd_texts(n):
    rng = random.Random(9)
    alphabet = " ▁▁\n\t\x00ab <s></s><unk><0x0A>é文😀́​�\xa0  Az1"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return texts + ["", " ", "  ", "▁", " a", "a ", "▁ ▁", "x" * 5000, " " * 700, "word " * 30_000]


def library_rows(model, rows):
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = [sp.encode(t or "", add_bos=True, add_eos=True) for _, t, *_ in rows]
    return sorted(((r[0], len(i), np.array(i, "<u4").tobytes(), sp.decode(i)) for r, i in zip(rows, ids)), key=str)


def round_trip(docs, model, **more):
    back = pieces.decode(pieces.encode(docs, model, **more), model)
    return sorted(((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in back.collect()), key=str)


@pytest.mark.parametrize("table_bytes", [pieces.TABLE_BYTES, 2000])
def test_pieces_match_the_library(make_docs, model, table_bytes):
    assert pieces.separable(model)
    rows = list(enumerate(odd_texts(1500)))
    assert round_trip(make_docs(rows), model, table_bytes=table_bytes) == library_rows(model, rows)


def test_table_segments_a_word_once(model):
    encoder = pieces.Encoder(model, False, False)
    asked = []

    class Counting:
        def encode(self, words, **more):
            asked.extend(words)
            return plain.encode(words, **more)

    plain, encoder.words = encoder.words, Counting()
    for _ in range(3):
        encoder.encode(["a b a  b", "b a", "a" * 600])
    assert sorted(w for w in asked if len(w) < 600) == ["▁a", "▁b", "▁▁b"]
    encoder.table_bytes = 0
    encoder.encode(["a"])
    assert asked.count("▁a") == 2


def test_models_whose_pieces_cross_markers_get_whole_texts(make_docs, model):
    from sentencepiece import sentencepiece_model_pb2
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(model)
    piece = spec.pieces.add()
    piece.piece, piece.score = "e▁t", 1.0
    crossing = spec.SerializeToString()
    assert not pieces.separable(crossing)
    rows = [(1, "the time e t"), (2, "one two"), (3, None)]
    got = round_trip(make_docs(rows), crossing)
    assert got == library_rows(crossing, rows) != library_rows(model, rows)


def test_pieces_edges(edge_docs, empty_docs, clashing, model):
    want = library_rows(model, EDGE_ROWS)
    assert round_trip(edge_docs, model) == want
    assert round_trip(clashing.withColumns({c: F.lit(1) for c in ("ids", "n_tokens", "decoded")}), model) == want
    assert round_trip(empty_docs, model) == []
    plain = pieces.encode(edge_docs, model, bos=False, eos=False).where("doc_id = 2").collect()
    assert [(r["n_tokens"], bytes(r["ids"])) for r in plain] == [(0, b"")]


def test_decode_of_null_ids(spark, model):
    rows = spark.createDataFrame([(1, None), (2, bytearray(b""))], "doc_id long, ids binary")
    assert [r["decoded"] for r in pieces.decode(rows, model).orderBy("doc_id").collect()] == ["", ""]
