"""The pipeline's stages against brute force, and the queries' contracts."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from duelframe.llm import mixing
from duelframe.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import EDGE_ROWS
from tests.llm.test_text_operators import brute_base, brute_components, brute_contamination, brute_fingerprint
from tests.oracle_util import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def edge_sf(spark, edge_docs, tmp_path_factory):
    """A folder of edge rows: documents, some labels, a benchmark."""
    d = str(tmp_path_factory.mktemp("sf"))
    edge_docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (6, 1, 0), (5, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, "one two"), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<float>").write.parquet(f"{d}/embeddings.parquet")
    return d


@pytest.fixture(scope="module")
def empty_sf(spark, edge_sf, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    for t in ("documents", "labels", "benchmark", "embeddings"):
        spark.read.parquet(f"{edge_sf}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    return d


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    ok, message = compare(spark, duck(SF), name, QUERIES[name], ORACLES[name], SF)
    assert ok, message


def test_mixing_oracle_where_few_passes_do_not_fill(spark):
    name, sf = "op4_source_mixing", "/root/testdata/sf0.01"
    ok, message = compare(spark, duck(sf), name, QUERIES[name], ORACLES[name], sf)
    assert ok, message


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_on_edge_and_empty_tables(spark, edge_sf, empty_sf, name):
    table = "embeddings" if "embedding" in name else "documents"
    rows = spark.read.parquet(f"{edge_sf}/{table}.parquet")
    n = 600 * rows.select("lang").distinct().count() if "audit" in name else rows.count()
    assert QUERIES[name](spark, edge_sf).count() == n
    assert QUERIES[name](spark, empty_sf).count() == 0


def test_pipeline_on_edge_and_empty_tables(spark, edge_sf, empty_sf):
    assert cp.run(spark, empty_sf).count() == 0
    rows = cp.run(spark, edge_sf).collect()
    assert {r["doc_id"] for r in rows} <= {r[0] for r in EDGE_ROWS}


def test_stages_return_document_columns(spark, edge_sf, edge_docs):
    for _, stage in cp.STAGES[:-1]:
        assert tuple(stage(spark, edge_docs, edge_sf).columns) == cp.COLUMNS


def test_near_duplicate_stage(spark, make_docs):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("ab cd ef gh ij kl".split()) for _ in range(30))) for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(10)] + [(None, rows[0][1]), (None, "z z z"), (None, "z z z"), (5, rows[5][1])]
    kept = cp.near_duplicate_stage(spark, make_docs(rows), SF).collect()
    fps = {i: brute_fingerprint(t) for i, t in rows if i is not None}
    comp = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    assert collections.Counter(r["doc_id"] for r in kept) == collections.Counter({c: 1 for c in set(comp.values())} | {None: 1})


def test_decontamination_stage(spark, make_docs, tmp_path):
    items = [(1, " ".join(f"w{i}" for i in range(30)))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "clean text"), (2, items[0][1]), (3, "x " * 300 + items[0][1]), (4, "x " * 20 + " ".join(items[0][1].split()[:13])), (5, None)]
    kept = {r["doc_id"] for r in cp.decontamination_stage(spark, make_docs(rows), str(tmp_path)).collect()}
    assert kept == {i for i, v in brute_contamination(rows, items).items() if not v[4]}


def test_secret_stage_leaves_no_base_secret(spark, make_docs):
    rows = [(1, "password: hunter22 tail"), (2, "clean"), (3, None), (4, "AKIA" + "B" * 20 + " and " + "a1" * 20)]
    out = {r["doc_id"]: r for r in cp.secret_stage(spark, make_docs(rows), SF).collect()}
    assert out[2]["text"] == "clean" and out[3]["text"] is None and all(brute_base(r["text"]) == "" for r in out.values())
    assert out[1]["n_chars"] == len(out[1]["text"])


def test_toxicity_stage_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = cp.toxicity_stage(spark, docs, sf).select("doc_id")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    by = {r["toxic"]: r["share"] for r in labels.join(kept.withColumn("kept", F.lit(1.0)), "doc_id", "left").groupBy("toxic").agg(
        F.avg(F.coalesce("kept", F.lit(0.0))).alias("share")).collect()}
    assert by[0] > 0.98 and by[1] < 0.4


def test_mixing_stage_returns_taken_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = cp.mixing_stage(spark, docs, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["copies"] in (1, 2, 3) and r["taken"] == r["copies"] * r["size"] and texts[r["doc_id"]] == r["text"] for r in rows)
    assert len({r["doc_id"] for r in rows}) == len(rows)


def test_mixing_stage_tells_sources_apart(spark, make_docs):
    words = " ".join(f"w{i}" for i in range(50))
    rows = [(1, words, "en", "s1"), (1, words, "en", "s2")] + [(k, words + f" x{k}", "en", "s3") for k in range(2, 30)]
    docs = make_docs(rows)
    name = F.struct(F.col("doc_id").alias("id"), F.col("source").alias("s"))
    mixed = mixing.mix(docs.select("text", "source", name.alias("name")), id_col="name").where("copies > 0")
    kept = cp.mixing_stage(spark, docs, SF).collect()
    assert len(kept) == len({(r["doc_id"], r["source"]) for r in kept}) == mixed.count()


def test_near_duplicate_stage_keeps_the_first_of_equal_rows(spark, make_docs):
    rows = [(1, "a b c", "en", s) for s in ("t", "s", None, "z")]
    for seed in range(3):
        kept = cp.near_duplicate_stage(spark, make_docs(random.Random(seed).sample(rows, 4), 4), SF).collect()
        assert [(r["doc_id"], r["source"]) for r in kept] == [(1, None)]
