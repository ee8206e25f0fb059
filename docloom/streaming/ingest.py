"""An addition: wiki part files are taken up as they arrive, and pass through the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.readers import WIKI


def follow_parts(spark: SparkSession, path: str, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 64) -> StreamingQuery:
    """Each micro-batch of new files goes through ``work`` and is appended to ``out``, in a folder of its own
    number, so that a batch that is run again after a failure replaces itself."""
    stream = spark.readStream.schema(WIKI).option("pathGlobFilter", "part-*").option("maxFilesPerTrigger", files_per_batch).parquet(path)

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
