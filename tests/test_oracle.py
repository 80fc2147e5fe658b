"""Every registered query with an oracle against DuckDB at sf 0.01, compared
as the driver does; queries without one must run; the driver contract."""

import os

import pytest

from duelframe.plans.registry import load_all
from tests.oracle_util import compare, duck

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

WITH_ORACLE = sorted(n for n, q in load_all().items() if q.sql is not None)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module")
def shared_tables():
    """All oracle queries here read one folder: its fan-out tables are written once."""
    from duelframe.plans import base
    plain, kept = base.materialise, {}

    def once(df, tag):
        if tag not in kept:
            kept[tag] = plain(df, tag)
        return kept[tag]

    base.materialise = once
    yield
    base.materialise = plain


@pytest.mark.parametrize("name", WITH_ORACLE)
def test_query_matches_oracle(spark, con, shared_tables, name):
    q = load_all()[name]
    ok, msg = compare(spark, con, name, q.build, q.sql, SF)
    assert ok, msg


@pytest.mark.parametrize("name", ["segment_enhanced_classification", "segment_enhanced_regression", "pca_scores_joined",
                                  "pca_team_features", "method_comparison", "anomaly_features"])
def test_wide_queries_have_one_row_a_key(spark, name):
    rows = load_all()[name].build(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and len(set(rows.columns)) == len(rows.columns)


def test_saved_model_scores_every_game(spark):
    from duelframe.plans.q_supervised import _regression_parts
    sf = "/root/testdata/sf0.001"
    scored = load_all()["saved_model_scoring"].build(spark, sf)
    n = load_all()["model_input_regression"].build(spark, sf).count()
    assert scored.count() == n and scored.where("prediction is null").count() == 0
    train, test, _ = _regression_parts(spark, sf, "PTS_home")
    assert abs(test.count() / n - 0.2) < 0.03 and train.count() + test.count() == n


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() == 10
    qs, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 100
