"""A folder that files are dropped into, processed as a stream: each file once, by the same plan as a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomdoc.config import ChunkingConfig, IntakeLimits
from loomdoc.functions.text import base_name
from loomdoc.operators.ocr import default_provider
from loomdoc.plans.batch import process


def watch(spark: SparkSession, folder: str, out: str, checkpoint: str, cfg: ChunkingConfig = ChunkingConfig(), limits: IntakeLimits = IntakeLimits(), provider: Callable = default_provider, files_per_batch: int = 1000, once: bool = True) -> StreamingQuery:
    """Chunks and outcomes of files that arrive in folder, as Parquet under out, a sub-folder for each batch.

    A file's result does not depend on others, so there is no state and no watermark; a batch that is run again after a
    failure overwrites its own sub-folders. once stops when all files at hand are done.
    """
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", files_per_batch).load(folder)
    files = stream.select("path", base_name(F.col("path")).alias("source_filename"), "content", F.col("length").alias("byte_size"), F.lit(None).cast("int").alias("file_idx"))

    def batch(df: DataFrame, n: int) -> None:
        rows, outcomes = process(df, cfg, limits, provider)
        rows.write.mode("overwrite").parquet(f"{out}/chunks/batch={n}")
        outcomes.write.mode("overwrite").parquet(f"{out}/outcomes/batch={n}")

    writer = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
