"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def tune(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings of the engine to a session builder.

    Partition counts stay with adaptive execution: it starts from
    ``spark.sql.shuffle.partitions`` and merges or splits by size.
    """
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        # Else every column object asks the JVM several times where it was written.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )


def local_session(cores: int | str = "*", app: str = "fareweather", **conf: str) -> SparkSession:
    """A local session for tests, notebooks and the bench."""
    builder = tune(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only where a session names none (a local test run) a new temporary folder
    is made and remembered in the session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    known = spark.conf.get("fareweather.scratch", None)
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="fareweather-")
    spark.conf.set("fareweather.scratch", made)
    return made


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")
