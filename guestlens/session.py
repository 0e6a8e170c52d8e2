"""Session settings used by the tests, the bench and local runs.

On a cluster the session comes from outside; nothing here overrides it.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the operators are written for."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("guestlens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shuffle_width(spark: SparkSession) -> int:
    """How many reduce tasks a shuffle of this session is planned for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def checkpoint_folder(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a scratch folder; on a cluster
    there is none, since a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None and spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="guestlens-checkpoint-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder and read from there.

    Later steps re-read files instead of repeating the work above, also after an
    executor is lost. A cluster session without ``spark.checkpoint.dir`` is an error, since
    everything above would silently be computed once per later step.
    """
    spark = df.sparkSession
    folder = checkpoint_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
