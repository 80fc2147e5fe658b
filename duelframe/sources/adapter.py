"""Contest views over the driver's TPC-H-style tables.

The driver ships orders/lineitem/customer/supplier/nation/region/part.  These
functions present them with the contest schema the library's jobs expect
(games, player lines, teams).  They only produce rows in that schema; every
job then does its own work on them and would run unchanged on real contest
tables of the same schema.

Mapping (fixed, see FIXTURES.md section 3):
  * an order is a game; its customer's nation is the home side, the nation of
    the supplier with the smallest key among its lines is the visiting side;
    orders whose two nations are equal are dropped;
  * lines 1-3 belong to the home side, lines 4+ to the visitor; per side,
    80 + sum(quantity) is the score, averages of discount / tax /
    extendedprice/100000 are the three rates, the line count is rebounds and
    the max quantity is assists;
  * every line is a player line (part = player);
  * a nation is a team, its region the city.

Scale: the lineitem aggregate is a shuffle on ``l_orderkey``; the join to
orders is on the same key so Spark reuses that partitioning on the lineitem
side.  customer / supplier joins are left to the planner (AQE turns them into
broadcast joins only when their run-time size is under the threshold).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOME_LINE_MAX = 3  # fixed value: lines 1..3 are the home side


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _side_aggregates(lineitem: DataFrame) -> DataFrame:
    home = F.col("l_linenumber") <= HOME_LINE_MAX
    away = F.col("l_linenumber") > HOME_LINE_MAX

    def on(cond, c):
        return F.when(cond, c)

    def exact_avg(cond, c):
        # sums of exact numbers: the same in every order of the rows
        total = F.sum(on(cond, F.col(c).cast("decimal(18,2)"))).cast("double")
        return total / F.nullif(F.count(on(cond, F.lit(1))), F.lit(0))

    scale = F.lit(100000.0)
    return lineitem.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("sk"),
        F.sum(on(home, F.col("l_quantity"))).alias("q_h"),
        F.sum(on(away, F.col("l_quantity"))).alias("q_a"),
        exact_avg(home, "l_discount").alias("d_h"),
        exact_avg(away, "l_discount").alias("d_a"),
        exact_avg(home, "l_tax").alias("t_h"),
        exact_avg(away, "l_tax").alias("t_a"),
        (exact_avg(home, "l_extendedprice") / scale).alias("p_h"),
        (exact_avg(away, "l_extendedprice") / scale).alias("p_a"),
        F.count(on(home, F.lit(1))).cast("double").alias("n_h"),
        F.count(on(away, F.lit(1))).cast("double").alias("n_a"),
        F.max(on(home, F.col("l_quantity"))).alias("k_h"),
        F.max(on(away, F.col("l_quantity"))).alias("k_a"),
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw games: GAME_ID, GAME_DATE_EST, SEASON, HOME_TEAM_ID, VISITOR_TEAM_ID,
    PTS_*, FG_PCT_*, FT_PCT_*, FG3_PCT_*, REB_*, AST_*, HOME_TEAM_WINS."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    a = _side_aggregates(table(spark, sf_dir, "lineitem"))
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(a, a.l_orderkey == o.o_orderkey)
          .join(s, s.s_suppkey == a.sk)
          .where(F.col("c_nationkey") != F.col("s_nationkey")))
    return j.select(
        F.col("o_orderkey").alias("GAME_ID"),
        F.to_date("o_orderdate").alias("GAME_DATE_EST"),
        F.year("o_orderdate").cast("int").alias("SEASON"),
        F.col("c_nationkey").cast("int").alias("HOME_TEAM_ID"),
        F.col("s_nationkey").cast("int").alias("VISITOR_TEAM_ID"),
        (F.lit(80.0) + F.col("q_h")).alias("PTS_home"),
        (F.lit(80.0) + F.col("q_a")).alias("PTS_away"),
        F.col("d_h").alias("FG_PCT_home"), F.col("d_a").alias("FG_PCT_away"),
        F.col("t_h").alias("FT_PCT_home"), F.col("t_a").alias("FT_PCT_away"),
        F.col("p_h").alias("FG3_PCT_home"), F.col("p_a").alias("FG3_PCT_away"),
        F.col("n_h").alias("REB_home"), F.col("n_a").alias("REB_away"),
        F.col("k_h").alias("AST_home"), F.col("k_a").alias("AST_away"),
        F.when(F.col("q_h") > F.col("q_a"), 1).otherwise(0).alias("HOME_TEAM_WINS"),
    )


def details(spark: SparkSession, sf_dir: str, games_df: DataFrame | None = None) -> DataFrame:
    """Player lines: GAME_ID, TEAM_ID, PLAYER_ID, PLAYER_NAME, PTS, REB, AST."""
    g = games_df if games_df is not None else games(spark, sf_dir)
    g = g.select("GAME_ID", "HOME_TEAM_ID", "VISITOR_TEAM_ID")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    j = g.join(li, li.l_orderkey == g.GAME_ID).join(p, p.p_partkey == li.l_partkey)
    return j.select(
        "GAME_ID",
        F.when(F.col("l_linenumber") <= HOME_LINE_MAX, F.col("HOME_TEAM_ID"))
         .otherwise(F.col("VISITOR_TEAM_ID")).alias("TEAM_ID"),
        F.col("p_partkey").alias("PLAYER_ID"),
        F.col("p_name").alias("PLAYER_NAME"),
        F.col("l_quantity").alias("PTS"),
        F.col("p_size").cast("double").alias("REB"),
        F.col("l_linenumber").cast("double").alias("AST"),
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams: TEAM_ID, NICKNAME, CITY, YEARFOUNDED."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("int").alias("TEAM_ID"),
        F.col("n_name").alias("NICKNAME"),
        F.col("r_name").alias("CITY"),
        (F.lit(1940) + F.col("n_nationkey")).alias("YEARFOUNDED"),
    )


class Contest:
    """The three contest tables of one scale-factor folder, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._games = None

    @property
    def games(self) -> DataFrame:
        if self._games is None:
            self._games = games(self.spark, self.sf_dir)
        return self._games

    @property
    def details(self) -> DataFrame:
        return self.details_of(self.games)

    def details_of(self, games_df: DataFrame) -> DataFrame:
        """Player lines of games that are already at hand."""
        return details(self.spark, self.sf_dir, games_df)

    @property
    def teams(self) -> DataFrame:
        return teams(self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


# DuckDB text of the same three views, pasted as CTEs in oracle SQL.
GAMES_SQL = """
SELECT o.o_orderkey AS GAME_ID, CAST(o.o_orderdate AS DATE) AS GAME_DATE_EST, CAST(year(o.o_orderdate) AS INT) AS SEASON,
       CAST(c.c_nationkey AS INT) AS HOME_TEAM_ID, CAST(s.s_nationkey AS INT) AS VISITOR_TEAM_ID,
       80 + a.q_h AS PTS_home, 80 + a.q_a AS PTS_away,
       a.d_h AS FG_PCT_home, a.d_a AS FG_PCT_away, a.t_h AS FT_PCT_home, a.t_a AS FT_PCT_away,
       a.p_h AS FG3_PCT_home, a.p_a AS FG3_PCT_away,
       a.n_h AS REB_home, a.n_a AS REB_away, a.k_h AS AST_home, a.k_a AS AST_away,
       CASE WHEN a.q_h > a.q_a THEN 1 ELSE 0 END AS HOME_TEAM_WINS
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN (SELECT l_orderkey, min(l_suppkey) AS sk,
        sum(CASE WHEN l_linenumber <= 3 THEN l_quantity END) AS q_h, sum(CASE WHEN l_linenumber > 3 THEN l_quantity END) AS q_a,
        {d_h} AS d_h, {d_a} AS d_a, {t_h} AS t_h, {t_a} AS t_a,
        {p_h} / 100000.0::DOUBLE AS p_h, {p_a} / 100000.0::DOUBLE AS p_a,
        CAST(count(CASE WHEN l_linenumber <= 3 THEN 1 END) AS DOUBLE) AS n_h, CAST(count(CASE WHEN l_linenumber > 3 THEN 1 END) AS DOUBLE) AS n_a,
        max(CASE WHEN l_linenumber <= 3 THEN l_quantity END) AS k_h, max(CASE WHEN l_linenumber > 3 THEN l_quantity END) AS k_a
      FROM lineitem GROUP BY l_orderkey) a ON a.l_orderkey = o.o_orderkey
JOIN supplier s ON s.s_suppkey = a.sk
WHERE c.c_nationkey <> s.s_nationkey
""".format(**{
    f"{short}_{side}": f"CAST(sum(CASE WHEN l_linenumber {cond} 3 THEN CAST({col} AS DECIMAL(18, 2)) END) AS DOUBLE) "
                       f"/ count(CASE WHEN l_linenumber {cond} 3 THEN 1 END)"
    for short, col in (("d", "l_discount"), ("t", "l_tax"), ("p", "l_extendedprice"))
    for side, cond in (("h", "<="), ("a", ">"))})

DETAILS_SQL = """
SELECT g.GAME_ID, CASE WHEN l.l_linenumber <= 3 THEN g.HOME_TEAM_ID ELSE g.VISITOR_TEAM_ID END AS TEAM_ID,
       p.p_partkey AS PLAYER_ID, p.p_name AS PLAYER_NAME, l.l_quantity AS PTS, CAST(p.p_size AS DOUBLE) AS REB, CAST(l.l_linenumber AS DOUBLE) AS AST
FROM games g JOIN lineitem l ON l.l_orderkey = g.GAME_ID JOIN part p ON p.p_partkey = l.l_partkey
"""

TEAMS_SQL = """
SELECT CAST(n.n_nationkey AS INT) AS TEAM_ID, n.n_name AS NICKNAME, r.r_name AS CITY,
       1940 + n.n_nationkey AS YEARFOUNDED
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
"""
