"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "duelframe",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on.

    AQE is on so that shuffle partitions coalesce at run time, skewed
    join partitions split, and sort-merge joins whose side turns out to be
    small at run time become broadcast joins (Spark checks the size).  The
    number of shuffle partitions is Spark's own unless given (AQE only merges
    partitions, so a cluster needs a high initial number).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):          # all tasks run in the driver's heap
        builder = builder.config("spark.driver.memory", os.environ.get("DUELFRAME_DRIVER_MEMORY", "8g"))
    spark = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be given (a shared file system); a
    machine-local folder would vanish with the executor.  Only a local
    session without the setting (tests, a laptop) gets a fresh folder of
    its own.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="duelframe-ckpt-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: computed
    once, lineage cut, columns pruned by each reader; a lost executor costs
    nothing that was written."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_spread(df: DataFrame, tag: str) -> DataFrame:
    """``materialise`` for a table that fits read in many costly passes: a table of
    fewer files than cores is dealt to as many, because a small file is one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    written = materialise(df, tag)
    return written if len(written.inputFiles()) >= cores else materialise(written.repartition(cores), tag)
