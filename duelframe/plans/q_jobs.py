"""Queries over the tables that whole jobs write (G1)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from duelframe.plans import jobs
from duelframe.plans.base import round_doubles, sql_with
from duelframe.plans.q_engineering import _BOX_SQL, _CLS_COLS, _GTD_SQL, _REG_COLS, _sql_dropna
from duelframe.plans.registry import query
from duelframe.session import checkpoint_dir

_SAVED = {"games_validated": "SELECT * FROM gv", "team_features_base": "SELECT * FROM tf", "game_level_features": "SELECT * FROM gl",
          "games_teams_details": _GTD_SQL, "model_input_classification": _sql_dropna(_CLS_COLS, ()),
          "model_input_regression": _sql_dropna(_REG_COLS, ())}


def _folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/jobs/{uuid.uuid4().hex}"


@query("data_job_tables", "G1 S2", sql=sql_with(" UNION ALL ".join(
    f"SELECT '{name}' AS \"TABLE\", count(*) AS \"ROWS\" FROM ({body})" for name, body in _SAVED.items()),
    extra=[("box", _BOX_SQL)]))
def data_job_tables(spark, sf_dir):
    """The job ``data_only`` run whole; the rows of every table it saved."""
    out = _folder(spark)
    jobs.run("data_only", spark, sf_dir, out)
    rows = [spark.read.parquet(f"{out}/{name}").agg(F.lit(name).alias("TABLE"), F.count(F.lit(1)).alias("ROWS")) for name in _SAVED]
    every = rows[0]
    for r in rows[1:]:
        every = every.unionByName(r)
    return every


@query("anomaly_job", "G1 N4 N5")
def anomaly_job(spark, sf_dir):
    """The job ``anomaly_only`` run whole; its consensus table read back."""
    out = _folder(spark)
    jobs.run("anomaly_only", spark, sf_dir, out)
    return round_doubles(spark.read.parquet(f"{out}/anomaly_consensus"))


@query("segment_job", "G1 K8")
def segment_job(spark, sf_dir):
    """The job ``quick_test`` run whole; its table of segmentations read back."""
    out = _folder(spark)
    jobs.run("quick_test", spark, sf_dir, out)
    return round_doubles(spark.read.parquet(f"{out}/clustering_evaluation"))
