"""Data-quality checks: each table is read once, schema checks cost nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mismatch_count(a: str, b: str) -> Column:
    """Rows where a != b, NULL on either side counting as a mismatch."""
    return F.count_if(F.coalesce(F.col(a) != F.col(b), F.lit(True)))


def _table_stats(df: DataFrame, key: str | None = None) -> DataFrame:
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    aggs = [F.count(F.lit(1)).alias("rows"), nulls.alias("nulls")]
    if key:
        aggs.append(F.count_distinct(key).alias("keys"))
    return df.agg(*aggs)


def validate(games: DataFrame, team_features: DataFrame, game_features: DataFrame,
             outcome_col: str = "HOME_TEAM_WINS", date_col: str = "GAME_DATE_EST",
             essential=("HOME_TEAM_ID", "VISITOR_TEAM_ID", "POINT_DIFFERENTIAL")) -> DataFrame:
    """Eight 0/1 checks plus the summary, as a long (CHECK, VALUE) table.

    One aggregation per table; the dtype and column checks are plan-time
    constants read from the schemas.
    """
    g = _table_stats(games).first()
    t = _table_stats(team_features, "TEAM_ID").first()
    f = _table_stats(game_features).first()
    types = dict((fl.name, fl.dataType) for fl in games.schema.fields)
    dtypes_ok = (isinstance(types.get(outcome_col), T.BooleanType)
                 and isinstance(types.get(date_col), (T.DateType, T.TimestampType, T.TimestampNTZType)))
    cols_ok = all(c in game_features.columns for c in essential)
    checks = [
        ("no_missing_games", int(g["nulls"] == 0)),
        ("no_missing_team_features", int(t["nulls"] == 0)),
        ("no_missing_game_features", int(f["nulls"] == 0)),
        ("games_not_empty", int(g["rows"] > 0)),
        ("team_features_not_empty", int(t["rows"] > 0)),
        ("game_features_not_empty", int(f["rows"] > 0)),
        ("correct_dtypes", int(dtypes_ok)),
        ("essential_columns_exist", int(cols_ok)),
    ]
    passed = int(all(v for _, v in checks))
    summary = [("summary.total_games", int(g["rows"])), ("summary.total_teams", int(t["keys"])),
               ("summary.total_features", len(game_features.columns)),
               ("summary.validation_passed", passed)]
    spark = games.sparkSession
    return spark.createDataFrame(checks + summary, "CHECK string, VALUE bigint")
