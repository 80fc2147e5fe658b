"""Ranking, top-k and dashboard reports over entity-season features.

Top-k uses ``orderBy(...).limit(k)``, which Spark plans as
TakeOrderedAndProject: every task keeps its own k best rows and only those
reach the final merge, so nothing unbounded meets one task.  Every order
carries a unique tie-breaker so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.functions.columns import columns_containing, round_even


def entity_all_season_means(features: DataFrame, cols: Sequence[str], entity: str = "TEAM_ID",
                            digits: int | None = 3) -> DataFrame:
    """Mean of each column over all seasons of an entity, rounded half-even."""
    aggs = [F.avg(c) for c in cols]
    if digits is not None:
        aggs = [round_even(a, digits) for a in aggs]
    return features.groupBy(entity).agg(*[a.alias(c) for a, c in zip(aggs, cols)])


def weakest_away(features: DataFrame, names: DataFrame | None = None, k: int = 10,
                 entity: str = "TEAM_ID") -> DataFrame:
    """Entities with the lowest all-season away win share (dashboard page).

    Per entity: rounded means of away/home win share and points, the
    home-minus-away differences, the entity name by lookup; k smallest by
    away win share, ties by entity id.
    """
    m = entity_all_season_means(features, ["AWAY_WIN_PCT", "AWAY_PTS_MEAN", "HOME_WIN_PCT", "HOME_PTS_MEAN"],
                                entity)
    m = m.withColumns({
        "WIN_PCT_DIFF": F.col("HOME_WIN_PCT") - F.col("AWAY_WIN_PCT"),
        "PTS_DIFF": F.col("HOME_PTS_MEAN") - F.col("AWAY_PTS_MEAN"),
    })
    if names is not None:
        m = m.join(names.select(F.col(entity), F.col("TEAM_NAME")), entity, "left")
    return m.orderBy(F.col("AWAY_WIN_PCT").asc(), F.col(entity).asc()).limit(k)


def top_k(df: DataFrame, by: str, k: int = 10, ascending: bool = False,
          tie: str | Sequence[str] = ()) -> DataFrame:
    """``nlargest``/``nsmallest`` with deterministic tie-breakers."""
    ties = [tie] if isinstance(tie, str) else list(tie)
    main = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(main, *[F.col(t).asc() for t in ties]).limit(k)


def closest(df: DataFrame, col: str, k: int = 10, tie: str = "GAME_ID") -> DataFrame:
    """Rows with the smallest |col| (closest contests)."""
    return df.orderBy(F.abs(F.col(col)).asc(), F.col(tie).asc()).limit(k)


def share_by(df: DataFrame, group: str | Sequence[str], flag: str, name: str, scale: float = 100.0) -> DataFrame:
    """Share of true ``flag`` per group, times ``scale``."""
    g = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*g).agg((F.avg(F.col(flag).cast("double")) * F.lit(scale)).alias(name))


def side_points_summary(games: DataFrame, entity: str, pts: str, prefix: str) -> DataFrame:
    """Mean / sample std / count of one side's points per entity."""
    return (games.where(F.col(entity).isNotNull())
                 .groupBy(F.col(entity).alias("TEAM_ID"))
                 .agg(F.avg(pts).alias(f"{prefix}_PTS_MEAN"), F.stddev_samp(pts).alias(f"{prefix}_PTS_STD"),
                      F.count(pts).alias(f"{prefix}_GAMES")))


def entity_overview(features: DataFrame, entity: str = "TEAM_ID") -> DataFrame:
    """All-season means of home/away win share and points plus differences."""
    m = entity_all_season_means(features, ["HOME_WIN_PCT", "AWAY_WIN_PCT", "HOME_PTS_MEAN", "AWAY_PTS_MEAN"],
                                entity, digits=None)
    return m.withColumns({
        "WIN_PCT_DIFF": F.col("HOME_WIN_PCT") - F.col("AWAY_WIN_PCT"),
        "PTS_DIFF": F.col("HOME_PTS_MEAN") - F.col("AWAY_PTS_MEAN"),
    })


def entity_vs_league(features: DataFrame, entity_id, cols: Sequence[str],
                     entity: str = "TEAM_ID") -> DataFrame:
    """Two rows, SCOPE = 'TEAM' (one entity's means) and 'LEAGUE' (all rows'
    means): the league averages next to one team, as a union, no cross join."""
    team = (features.where(F.col(entity) == F.lit(entity_id))
                    .agg(*[F.avg(c).alias(c) for c in cols]).withColumn("SCOPE", F.lit("TEAM")))
    league = features.agg(*[F.avg(c).alias(c) for c in cols]).withColumn("SCOPE", F.lit("LEAGUE"))
    return team.unionByName(league)


def game_kpis(games: DataFrame) -> DataFrame:
    """Count, home-win %, mean home and away points (one global aggregate)."""
    return games.agg(
        F.count(F.lit(1)).alias("GAMES"),
        (F.avg(F.col("HOME_TEAM_WINS").cast("double")) * 100).alias("HOME_WIN_PCT"),
        F.avg("PTS_home").alias("AVG_PTS_HOME"),
        F.avg("PTS_away").alias("AVG_PTS_AWAY"))


def table_status(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per named table: row count and column count."""
    rows = [df.agg(F.count(F.lit(1)).alias("ROWS"))
              .select(F.lit(name).alias("TABLE"), "ROWS", F.lit(len(df.columns)).alias("COLUMNS"))
            for name, df in tables.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def latest_per_entity(df: DataFrame, entity: str = "TEAM_ID", order: str = "SEASON",
                      earliest: bool = False) -> DataFrame:
    """One row per entity: the latest (or earliest) by ``order``.

    ``max_by``/``min_by`` over a struct keeps it a partial aggregation
    (no per-entity sort of all its rows)."""
    others = [c for c in df.columns if c != entity]
    pick = F.min_by if earliest else F.max_by
    s = F.struct(*others)
    return df.groupBy(entity).agg(pick(s, F.struct(order, *[c for c in others if c != order])).alias("__r")) \
             .select(entity, "__r.*")


def entity_trend(features: DataFrame, entity_id, cols: Sequence[str], entity: str = "TEAM_ID",
                 season: str = "SEASON") -> DataFrame:
    """One entity's rows by season (trend chart data)."""
    return features.where(F.col(entity) == F.lit(entity_id)).select(entity, season, *cols).orderBy(season)


def filter_entity(df: DataFrame, entity_id, season=None, entity: str = "TEAM_ID",
                  season_col: str = "SEASON") -> DataFrame:
    """Rows of one entity, of one season unless ``season`` is None or 'all'."""
    out = df.where(F.col(entity) == F.lit(entity_id))
    return out if season is None or season == "all" else out.where(F.col(season_col) == F.lit(season))


def quick_ranking(features: DataFrame, entity: str = "TEAM_ID", k: int = 10,
                  needles: Sequence[str] = ("WIN", "PCT")) -> DataFrame:
    """Rank entities by the mean of the first column whose name holds
    WIN or PCT (picked from the schema), top k, ties by id."""
    cand = [c for c in columns_containing(features, needles) if c != entity]
    if not cand:
        raise ValueError("no column with WIN/PCT in its name")
    metric = cand[0]
    m = features.groupBy(entity).agg(F.avg(metric).alias("METRIC_MEAN")).withColumn("METRIC", F.lit(metric))
    return m.orderBy(F.col("METRIC_MEAN").desc(), F.col(entity).asc()).limit(k)
