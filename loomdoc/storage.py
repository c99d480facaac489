"""The folder that driver and executors share, and tables written there to cut a plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one of our own only where none is set and all runs on one machine."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        found = "file://" + tempfile.mkdtemp(prefix="loomdoc-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there.

    The shuffles that fed it are dropped at once; the files go when Spark no longer refers to them
    (spark.cleaner.referenceTracking.cleanCheckpoints), and any executor may be lost afterwards.
    """
    spark = df.sparkSession
    shared_dir(spark)
    before = spark.conf.get(FILE_CLEANUP, "false")
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        # the mode is fixed when a DataFrame is made, so make one under the setting
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(FILE_CLEANUP, before)
