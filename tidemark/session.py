"""Session settings the library is designed for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that may be changed on a running session.  AQE sizes reducers and splits oversized
# join partitions; `forceOptimizeSkewedJoin` lets it do so even where that costs one more shuffle.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Without a record of the Python line of every Column, wide plans are built several times faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


_OWN: list[str] = []  # the folder of a local session that names none


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for tables of its own and stream progress, as `spark.checkpoint.dir` names it.

    A local session that names none gets a new folder; on a cluster that is an error, for executors on other
    machines would not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="tidemark-"))
    return _OWN[0]
