"""Benchmark: wall time of the headline queries on one scale-factor folder.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is fully executed with the ``noop`` sink (every row computed,
nothing collected to the driver), cold: every run reads the input tables
itself, and no cached or saved table and no fit of another run is used.  The relational
queries run a second time on the warmed JVM (``warm``); model queries run
once.  Prints ONE JSON line; ``value`` is the sum of the
cold times of the relational queries.
"""

from __future__ import annotations

import json
import os
import platform
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "weakest_away_teams",
    "games_validated",
    "team_features_base",
    "game_level_features",
    "games_teams_details",
    "players_games_teams",
    "describe_games",
    "correlation_matrix_games",
    "recent_form",
    "head_to_head",
    "leak_free_game_features",
    "classification_auc",
    "regression_scores",
    "segment_profile",
]
MODELS = ["segment_gain", "saved_model_scoring"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from duelframe.plans.q_supervised import forget
    from duelframe.plans.registry import load_all
    from duelframe.session import get_session

    spark = get_session(f"local[{cpus}]", app="duelframe-bench", shuffle_partitions=int(cpus))
    reg = load_all()

    def run(name: str, folder: str) -> float:
        spark.catalog.clearCache()
        forget()
        t0 = time.perf_counter()
        reg[name].build(spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3)

    # start the JVM's class loading and code generation on the smallest folder
    small = "/root/testdata/sf0.001"
    if os.path.isdir(small):
        run("weakest_away_teams", small)
    times = {name: run(name, sf_dir) for name in HEADLINE}
    warm = {name: run(name, sf_dir) for name in HEADLINE}
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "warm": warm,
        "models": {name: run(name, sf_dir) for name in MODELS},
        "sf": float(m.group(1)) if m else sf_dir,
        "spark": spark.version,
        "cpus": int(cpus),
        "machine": platform.machine(),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
