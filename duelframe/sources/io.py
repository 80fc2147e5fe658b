"""Readers and writers: CSV with a declared schema, parquet, JSON reports,
and a lookup table with a literal fallback.  Paths are folders on the shared
file system (the session's checkpoint folder when none is given)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed value: schema of the raw games file (dates parsed, ids as LONG)
GAMES_CSV_SCHEMA = T.StructType([
    T.StructField("GAME_ID", T.LongType()), T.StructField("GAME_DATE_EST", T.DateType()),
    T.StructField("SEASON", T.IntegerType()), T.StructField("HOME_TEAM_ID", T.IntegerType()),
    T.StructField("VISITOR_TEAM_ID", T.IntegerType()),
    *[T.StructField(c, T.DoubleType()) for c in (
        "PTS_home", "PTS_away", "FG_PCT_home", "FG_PCT_away", "FT_PCT_home", "FT_PCT_away",
        "FG3_PCT_home", "FG3_PCT_away", "REB_home", "REB_away", "AST_home", "AST_away")],
    T.StructField("HOME_TEAM_WINS", T.IntegerType()),
])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; rows keep their real keys (no positional index)."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV scan with a declared schema (no inference pass over the data)."""
    return (spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd")
            .option("mode", "FAILFAST").csv(path))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """JSON report sink: a small report table written as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def names_or_default(spark: SparkSession, teams: DataFrame | None, default: dict[int, str]) -> DataFrame:
    """Team id -> name from the teams table (NICKNAME, else ABBREVIATION);
    when no table is available, the given literal map."""
    if teams is not None:
        col = "NICKNAME" if "NICKNAME" in teams.columns else "ABBREVIATION"
        return teams.select(F.col("TEAM_ID"), F.col(col).alias("TEAM_NAME"))
    return spark.createDataFrame(sorted(default.items()), "TEAM_ID long, TEAM_NAME string")


def folder_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the entries of a folder, read through Spark's file systems."""
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = base.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(base)
    return tuple(sorted((x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in found))
