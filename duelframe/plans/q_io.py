"""Source / sink queries (S1-S4, S7): each writes to the shared folder and
reads the result back through the library's readers."""

from __future__ import annotations

import uuid

from duelframe.plans.base import GAME_DOUBLES, Stages, round_doubles, sql_round, sql_with
from duelframe.plans.q_profile import validation_sql
from duelframe.plans.registry import query
from duelframe.session import checkpoint_dir
from duelframe.sources import io


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/io/{name}-{uuid.uuid4().hex[:8]}"


_RAW_COLS = ["GAME_ID", "GAME_DATE_EST", "SEASON", "HOME_TEAM_ID", "VISITOR_TEAM_ID"] + GAME_DOUBLES + ["HOME_TEAM_WINS"]


@query("games_csv_roundtrip", "S1 S3", sql=sql_with(
    f"SELECT * REPLACE ({sql_round(GAME_DOUBLES)}) FROM games", upto="games"))
def games_csv_roundtrip(spark, sf_dir):
    """Raw games written as CSV with a header and read back with the
    declared schema (parsed date, typed ids and scores)."""
    st = Stages(spark, sf_dir)
    path = _scratch(spark, "games_csv")
    io.write_csv(st.c.games.select(*_RAW_COLS), path)
    return round_doubles(io.read_csv(spark, path, io.GAMES_CSV_SCHEMA))


@query("team_features_parquet_roundtrip", "S2", sql=sql_with("SELECT TEAM_ID, SEASON, HOME_GAMES_COUNT, AWAY_GAMES_COUNT, "
                                                             "round_even(HOME_WIN_PCT, 6) AS HOME_WIN_PCT FROM tf",
                                                             upto="tf"))
def team_features_parquet_roundtrip(spark, sf_dir):
    """Team features written as parquet partitioned by season, read back
    with a pruned projection."""
    st = Stages(spark, sf_dir)
    path = _scratch(spark, "team_features")
    io.write_parquet(st.team_features, path, ["SEASON"])
    back = spark.read.parquet(path).select("TEAM_ID", "SEASON", "HOME_GAMES_COUNT", "AWAY_GAMES_COUNT", "HOME_WIN_PCT")
    return round_doubles(back)


@query("validation_report_json", "S4 Q0", sql=sql_with(validation_sql(), upto="gl"))
def validation_report_json(spark, sf_dir):
    """The quality report written with the JSON sink and read back."""
    from duelframe.operators import quality
    st = Stages(spark, sf_dir)
    rep = quality.validate(st.games_validated, st.team_features, st.game_features)
    path = _scratch(spark, "validation_report")
    io.write_report(rep, path)
    return io.read_report(spark, path, "CHECK string, VALUE bigint")


@query("team_names_with_fallback", "S7 J8", sql=sql_with("SELECT TEAM_ID, NICKNAME AS TEAM_NAME FROM teams",
                                                         upto="teams"))
def team_names_with_fallback(spark, sf_dir):
    """Team id -> name from the teams table (the literal map is only used
    when no table exists)."""
    st = Stages(spark, sf_dir)
    return io.names_or_default(spark, st.c.teams, {})
