"""Each operator against a brute-force version, and on the edge rows."""

import collections
import hashlib
import random
import re

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from duelframe.llm import decontaminate, licences, mixing, secrets, simhash, substrings
from duelframe.llm.common import utf8_view
from tests.llm.conftest import EDGE_ROWS

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def words():
    rng = random.Random(1)
    return ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(400)]


# -- SimHash ---------------------------------------------------------------------

def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(values, linked):
    """Smallest key reachable for each key of {key: value}."""
    keys = sorted(values)
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if linked(values[a], values[b]):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("bucket", [64, 1])
def test_simhash_matches_brute_force(make_docs, words, bucket):
    rng = random.Random(2)
    rows = [(r[0], r[1]) for r in EDGE_ROWS if r[0] is not None and r[0] != 8] + [(8, EDGE_ROWS[7][1])]
    for i in range(100, 160):
        rows.append((i, prose(rng, 200, words)))
        rows.append((i + 100, rows[-1][1].replace(rng.choice(words), "edit", 1)))
    got = {r[0]: (r[1], r[2]) for r in simhash.near_duplicates(make_docs(rows), bucket=bucket).collect()}
    fps = {i: brute_fingerprint(t) for i, t in rows}
    comp = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    assert got == {i: (f"{fps[i]:016x}", comp[i]) for i in fps}
    assert len(set(comp.values())) < len(comp)


@pytest.mark.parametrize("max_bits", [0, 1])
def test_simhash_smaller_distances(spark, make_docs, max_bits):
    docs = make_docs([(i, t) for i, t in enumerate(["a b c d", "a b c d", "a b c e", "q", ""])])
    got = {r[0]: r[2] for r in simhash.near_duplicates(docs, max_bits=max_bits).collect()}
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()}
    assert got == brute_components(fps, lambda a, b: (a ^ b).bit_count() <= max_bits)


def test_links_of_a_dense_group(spark):
    """A full bucket is re-keyed: same components as comparing all pairs."""
    rng = random.Random(3)
    base = 0x0123456789ABCDEF
    values = {base}
    while len(values) < 120:
        v = rng.choice(sorted(values))
        values.add(v ^ 1 << rng.randrange(60) ^ (1 << rng.randrange(60) if rng.random() < .7 else 0))
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    expect = brute_components({v: v for v in values}, lambda a, b: (a ^ b).bit_count() <= 2)
    for bucket in (4, 64, 1000):
        from duelframe.llm.components import connected_components
        got = {r["node"]: r["label"] for r in connected_components(simhash.links(df, bucket)).collect()}
        assert {v: got.get(v, v) for v in values} == expect


def test_simhash_edges(edge_docs, empty_docs, clashing):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == len(EDGE_ROWS)
    by = collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append((r["fingerprint"], r["component_id"]))
    assert by[1] == by[2] == by[3] == [("0" * 16, 1)]
    assert by[6] == by[7] and by[8] == by[6] * 2 and ("0" * 16, 1) in by[None] and by[6][0] in by[None]
    assert simhash.near_duplicates(empty_docs).count() == 0
    assert sorted(map(str, simhash.near_duplicates(clashing).collect())) == sorted(map(str, rows))


# -- decontamination -----------------------------------------------------------------

def brute_contamination(docs, items, window=13):
    wins = collections.defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            wins[tuple(w[k:k + n])].add(i if i is None else str(i))
    out = {}
    for d, t in docs:
        w = ALNUM.findall(lower(t))
        hit, found = set(), set()
        for n in {len(k) for k in wins}:
            for k in range(len(w) - n + 1):
                own = wins.get(tuple(w[k:k + n]))
                if own:
                    hit |= set(range(k, k + n))
                    found |= own
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found - {None})).encode()).hexdigest(),
                  len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("block_words", [1 << 20, 60])
def test_contamination_matches_brute_force(spark, make_docs, words, block_words):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randint(1, 40), words[:60])) for i in range(30)] + [(40, ""), (41, None), (42, "only"), (43, "Two WORDS")]
    docs = []
    for i in range(90):
        text = prose(rng, rng.randint(0, 80), words[:60])
        if i % 3:
            text += ", " + (rng.choice(items[:30])[1]).upper() + "; tail"
        docs.append((i, text))
    docs += [(100, None), (101, ""), (102, "..."), (103, "only"), (104, "a two words b")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in decontaminate.digest(
        decontaminate.contamination(make_docs(docs), bench, block_words=block_words)).collect()}
    assert got == brute_contamination(docs, items)
    assert any(v[4] for v in got.values()) and not all(v[4] for v in got.values())


def test_contamination_edges(spark, edge_docs, empty_docs, clashing):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta", "x"), (1, "alpha beta gamma delta", "y"), (None, "one", "z")],
                                  "item_id long, text string, doc_id string")
    rows = decontaminate.digest(decontaminate.contamination(edge_docs, bench)).collect()
    want = brute_contamination(list(enumerate(t for _, t in EDGE_ROWS)), [(r[0], r[1]) for r in bench.collect()])
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(str((r[0], *want[i])) for i, r in enumerate(EDGE_ROWS))
    assert sorted(map(str, decontaminate.digest(decontaminate.contamination(clashing, bench)).collect())) == sorted(map(str, rows))
    assert decontaminate.contamination(empty_docs, bench).count() == 0
    assert not any(r["n_items"] for r in decontaminate.digest(decontaminate.contamination(edge_docs, bench.limit(0))).collect())


@pytest.mark.parametrize("block_words", [1 << 20, 40])
def test_null_item_ids_are_searched_and_count_as_one(spark, make_docs, words, block_words):
    rng = random.Random(14)
    items = [(i if i % 3 else None, prose(rng, rng.randint(1, 20), words[:40])) for i in range(25)] + [(None, None)]
    docs = [(k, prose(rng, 30, words[:40]) + " " + items[k % 25][1]) for k in range(50)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(make_docs(docs), bench, block_words=block_words)
    assert {r[0]: tuple(r)[1:] for r in decontaminate.digest(found).collect()} == brute_contamination(docs, items)


def test_items_of_one_window_are_not_multiplied_by_its_occurrences(spark, make_docs):
    items = [(str(i), "the") for i in range(10_000)]
    tests = decontaminate.TestSet.build(items, 13)
    shard = decontaminate.Shard(tests)
    text = pa.array(["the " * 10_000])
    data, off = utf8_view(text)
    shard.add(pa.RecordBatch.from_arrays([pa.array([1])], ["doc_id"]), data, off)
    assert len(shard.spans()[0]) == 10_000
    bench = spark.createDataFrame([(int(i), t) for i, t in items], "item_id long, text string")
    got = decontaminate.contamination(make_docs([(1, "the " * 10_000)]), bench).collect()[0]
    assert len(got["items"]) == 10_000 and got["span_starts"] == [0] and got["span_ends"] == [10_000]


def test_fm_index_against_scanning():
    import numpy as np
    rng = np.random.default_rng(5)
    text = rng.integers(1, 6, 500)
    index = decontaminate.FMIndex(text, 5)
    for m in (1, 2, 4):
        patterns = rng.integers(1, 7, (40, m)).clip(max=5)
        lo, hi = index.search(patterns)
        for p, a, b in zip(patterns, lo, hi):
            expect = [i for i in range(len(text) - m + 1) if (text[i:i + m] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == expect


# -- repeated substrings ----------------------------------------------------------------

def brute_removal(rows, length):
    seen = collections.Counter(b[p:p + length] for _, b in rows for p in range(len(b) - length + 1))
    out = []
    for i, b in rows:
        covered = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                covered[p:p + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, covered) if not c)
        spans = sum(1 for p in range(len(b)) if covered[p] and (p == 0 or not covered[p - 1]))
        out.append((i, len(b), sum(covered), spans, kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("length,gram,shard_bytes", [(40, 8, 1 << 20), (40, 8, 500), (100, 32, 300), (200, 16, 1 << 16)])
def test_substrings_match_brute_force(make_docs, words, length, gram, shard_bytes):
    rng = random.Random(length)
    passages = [prose(rng, 60, words) for _ in range(6)] + ["ab" * 150, "z" * 400]
    rows = [(1, None), (2, ""), (3, "short"), (None, passages[0])]
    for i in range(10, 70):
        parts = [prose(rng, rng.randint(0, 40), words), rng.choice(passages), prose(rng, rng.randint(0, 40), words)]
        if i % 4 == 0:
            parts[1] = parts[1][rng.randint(0, 30):-rng.randint(1, 30)]
        rows.append((i, " ".join(parts)))
    rows += [(80, rows[10][1]), (80, rows[10][1])]
    cut = substrings.deduplicate(make_docs(rows), length=length, gram=gram, shard_bytes=shard_bytes).collect()
    got = sorted([(r["doc_id"], r["n_bytes"], sum(r["span_ends"]) - sum(r["span_starts"]), len(r["span_starts"]), bytes(r["kept"]))
                  for r in cut], key=str)
    assert got == brute_removal([(i, (t or "").encode()) for i, t in rows], length)


def test_substrings_edges(edge_docs, empty_docs, clashing):
    rows = substrings.deduplicate(edge_docs).collect()
    assert len(rows) == len(EDGE_ROWS) and substrings.deduplicate(empty_docs).count() == 0
    by = {r["doc_id"]: r for r in rows}
    assert bytes(by[12]["kept"]) == b"" and bytes(by[10]["kept"]) == b"" and bytes(by[4]["kept"]) == b"one"
    assert len(substrings.deduplicate(clashing).collect()) == len(EDGE_ROWS)


def test_equal_rows_do_not_multiply_their_spans(spark, make_docs, words):
    text = prose(random.Random(2), 300, words)
    rows = make_docs([(None, text)] * 50).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"), "text")
    spans = substrings.repeated_spans(rows, 40, 8, 1 << 16).collect()
    assert len(spans) == 1 and len(spans[0]["spans"]) == len({(s["s"], s["e"]) for s in spans[0]["spans"]})
    got = substrings.deduplicate(make_docs([(None, text)] * 50), length=40, gram=8).collect()
    assert all(r["kept"] == b"" for r in got) and len(got) == 50


def test_passages_of_over_50_words_go_by_their_bytes(make_docs, words, tmp_path):
    """The query removes 400 bytes and more that other documents hold, and leaves shorter passages and clean documents whole."""
    from duelframe.llm import queries
    rng = random.Random(8)
    long = [prose(rng, 120, words) for _ in range(4)] + ["éß" * 100, ("x" + "ab" * 200)[:400]]
    short = [" ".join(w[:5] for w in prose(rng, 55, words).split()) for _ in range(4)]
    assert all(len(p.encode()) >= 400 for p in long) and all(len(p.split()) > 50 and len(p.encode()) < 380 for p in short)
    rows, planted = [], {}
    for i in range(60):
        planted[i] = (long * 5 + short * 3 + [""] * 18)[i]
        rows.append((i, " ".join([prose(rng, rng.randint(30, 90), words), planted[i], prose(rng, rng.randint(30, 90), words)])))
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_suffix_array_dedup"](make_docs([]).sparkSession, str(tmp_path)).collect()}
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], r["n_kept"]) for r in got.values()) == [
        (i, n, removed, spans, hashlib.sha256(kept).hexdigest(), len(kept))
        for i, n, removed, spans, kept in sorted(brute_removal([(i, t.encode()) for i, t in rows], 400))]
    assert all((got[i]["n_removed"] >= len(p.encode())) if p in long else got[i]["n_removed"] == 0 for i, p in planted.items())


def test_starts_of_periodic_texts_match_brute_force():
    for seed in range(100):
        rng = random.Random(seed)
        texts = []
        for _ in range(rng.randint(2, 8)):
            unit = "".join(rng.choice("ab") for _ in range(rng.randint(1, 9)))
            head = "".join(rng.choice("abc") for _ in range(rng.randint(0, 5)))
            texts.append(((head + unit * 60)[:rng.randint(45, 110)] + rng.choice(["", "x", "ab", "ba"])).encode())
        texts = list(dict.fromkeys(texts))
        seen = collections.Counter(b[p:p + 40] for b in texts for p in range(len(b) - 39))
        got = substrings.suffix_starts(texts, 40)
        assert [m.tolist() for m in got] == [[seen[b[p:p + 40]] > 1 for p in range(len(b) - 39)] for b in texts], seed


def test_suffix_ranks_and_prefixes():
    import numpy as np
    rng = np.random.default_rng(0)
    text = np.append(rng.integers(1, 4, 300), 0)
    rank = substrings.sort_suffixes(text, 10 ** 6)
    expect = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert np.argsort(rank).tolist() == expect
    sa = np.argsort(rank)
    lcp = substrings.common_prefixes(text, sa, np.array([0]), np.array([len(text)]), 10 ** 4)
    for a, b in zip(expect, expect[1:]):
        n = 0
        while text[a + n] == text[b + n] != 0:
            n += 1
        assert lcp[b] == n


# -- secrets --------------------------------------------------------------------------------

def brute_base(text):
    text, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out.append((m.start(), 2, "hex", m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


SECRET_TEXTS = [
    None, "", "password: hunter22", "PassWord='abc' token=token:password=longenough1", "é token = \"0123456789abcdef0123456789abcdef\"",
    "AKIA" + "A" * 15 + " AKIA" + "Z9" * 10, "apikey:x api_key: aaaaaa secret=" + "b" * 40, "f" * 23 + " " + "f" * 24 + "g",
    "user: bob far " + "x " * 150 + "password: secret99", "user: alice password: secret99 https://db.example.org/x",
    "https://plain.example.org and user: carol", "Zm9vYmFyYmF6cXV4MTIzNDU2 near login=dora",
    "Zm9vYmFyYmF6cXV4MTIzNDU2 alone", "token=" * 50, "😀 secret: 😀 secret: abcdefg",
]


def test_secrets_base_spans(make_docs):
    docs = make_docs(list(enumerate(SECRET_TEXTS)))
    rows = secrets.scan(docs).select("doc_id", "n_assign", "n_access", "n_hex", secrets.listed(F.col("base")).alias("b"),
                                     secrets.listed(F.col("spans")).alias("s")).collect()
    got = {r["doc_id"]: r for r in rows}
    for i, t in enumerate(SECRET_TEXTS):
        want = brute_base(t)
        assert got[i]["b"] == want
        for k in ("assign", "access", "hex"):
            assert got[i][f"n_{k}"] == want.count(k + ":")
        assert set(filter(None, want.split(","))) <= set(got[i]["s"].split(","))
    linked = {i: [x.split(":")[0] for x in r["s"].split(",")] for i, r in got.items()}
    assert "ident" not in linked[8] and {"ident", "endpoint"} <= set(linked[9])
    assert linked[10] == [""] and set(linked[11]) == {"opaque", "ident"} and linked[12] == [""]


def test_secrets_redact(make_docs):
    docs = make_docs(list(enumerate(SECRET_TEXTS)) + [(2, SECRET_TEXTS[2])])
    spans = {r["doc_id"]: r["spans"] for r in secrets.scan(docs).collect()}
    out = secrets.redact(docs).collect()
    assert len(out) == len(SECRET_TEXTS) + 1
    for r in out:
        text, want, at = SECRET_TEXTS[r["doc_id"]], "", 0
        merged = []
        for s in spans[r["doc_id"]] or []:
            if merged and s["start"] <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], s["end"])
            else:
                merged.append([s["start"], s["end"]])
        for a, b in merged:
            want += text[at:a] + secrets.MARK
            at = b
        assert r["text"] == (None if text is None else want + text[at:])
        assert r["redacted"] == bool(merged)


def test_secrets_edges(edge_docs, empty_docs, clashing):
    assert secrets.scan(edge_docs).count() == len(EDGE_ROWS) and secrets.scan(empty_docs).count() == 0
    assert secrets.scan(clashing).count() == len(EDGE_ROWS) and secrets.redact(empty_docs).count() == 0
    assert sorted(map(str, (r["text"] for r in secrets.redact(edge_docs).collect()))) == sorted(str(t[1]) for t in EDGE_ROWS)


# -- licences --------------------------------------------------------------------------------

def test_licences(make_docs):
    mit = dict(licences.LICENCES[:1])["MIT"]
    texts = {
        1: mit, 2: mit.replace("\n", " ").upper(), 3: "Copyright (c) 2020 Someone\n" + mit, 4: mit + " extra",
        5: "Some text.\nReleased under the MIT Licence!\nMore.", 6: "intro\n\n" + mit + "\n\noutro",
        7: "Licensed under the Apache License, Version 2.0.", 8: "LICENSED UNDER THE APACHE LICENCE version 2.0",
        9: None, 10: "", 11: "no licence here, just a permitted word", 12: mit.replace("sublicense", "sublicence"),
    }
    got = {r["doc_id"]: r for r in licences.scan(make_docs(list(texts.items()))).collect()}
    assert [got[i]["whole_license"] for i in (1, 2, 3, 4, 7, 8)] == ["MIT", "MIT", "MIT", None, "Apache-2.0", "Apache-2.0"]
    assert got[5]["licenses"] == "MIT" and got[5]["whole_license"] is None and got[6]["licenses"] == "MIT"
    assert [got[i]["n_licenses"] for i in (4, 9, 10, 11)] == [0, 0, 0, 0]


def test_every_known_text_holds_a_cue():
    assert all(re.search(licences.CUES, t, re.I) for _, t in licences.LICENCES)


def test_licence_edges(edge_docs, empty_docs, clashing):
    assert licences.scan(edge_docs).count() == len(EDGE_ROWS) and licences.scan(empty_docs).count() == 0
    assert licences.scan(clashing).count() == len(EDGE_ROWS)


# -- mixing --------------------------------------------------------------------------------------

def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > 3 * sizes[s]]
        if not over:
            target.update({s: unit * weight[s] for s in open_})
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def test_mix_meets_targets(make_docs, words):
    rng = random.Random(7)
    rows = [(i, prose(rng, int(rng.paretovariate(1.2) * 5) + 1, words), "en", rng.choice(["a", "a", "a", "a", "b", "c", None, "é", "tiny" if i % 50 == 0 else "b"]))
            for i in range(900)]
    rows += [(5000, None, "en", "a"), (5001, "", "en", "empty"), (None, "a b c", "en", "a"), (7, "one two", "en", "a"), (7, "one two", "en", "a")]
    docs = make_docs(rows)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    sizes, taken = collections.Counter(), collections.Counter()
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
    expect = brute_targets(sizes)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(expect[r["source"]])
    for s, n in taken.items():
        assert abs(n - expect[s]) <= max(3, 0.02 * expect[s]), (s, n, expect[s])
    again = mixing.mix(docs.repartition(7), buckets=16).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_mix_fills_until_nothing_fits(make_docs):
    sizes = [1 << e for e in range(9) for _ in range(3)]
    rows = [(k * 100 + i, "w " * n, "en", f"s{k:02d}") for k in range(40) for i, n in enumerate([*sizes, k + 1])]
    left, open_ = {}, {}
    for r in mixing.mix(make_docs(rows), weights=(1,), share=0.5).collect():
        left[r["source"]] = left.get(r["source"], r["target"]) - r["taken"]
        if not r["copies"]:
            open_.setdefault(r["source"], []).append(r["size"])
    assert len(left) == 40 and all(rest >= 0 and rest < min(open_[k]) for k, rest in left.items())


def test_mix_edges(edge_docs, empty_docs, clashing):
    rows = mixing.mix(edge_docs).collect()
    assert len(rows) == len(EDGE_ROWS) and mixing.mix(empty_docs).count() == 0
    assert sorted(map(str, mixing.mix(clashing).collect())) == sorted(map(str, rows))
