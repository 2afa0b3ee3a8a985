"""Structured Streaming: appending as results come, and resuming after a stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append_new(stream: DataFrame, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], key: str) -> StreamingQuery:
    """Append ``transform`` of what has come in since the last run to the Parquet table ``out``, then stop.

    A batch that is run again after a crash adds nothing twice: keys that ``out`` already has are left out, and a batch's
    own repeats are dropped.
    """

    def write(batch: DataFrame, _: int) -> None:
        spark, rows = batch.sparkSession, transform(batch).dropDuplicates([key])
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            rows = rows.join(spark.read.parquet(out).select(key), key, "left_anti")
        rows.write.mode("append").parquet(out)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, key: str, width: str, late: str, slide: str | None = None) -> DataFrame:
    """Counts and sums by event-time window and key, tumbling or sliding, with a watermark; works on batch tables too."""
    rows = stream.withWatermark(time, late) if stream.isStreaming else stream
    return rows.groupBy(F.window(time, width, slide) if slide else F.window(time, width), key).agg(F.count("*").alias("n"))


def sessions(stream: DataFrame, time: str, key: str, gap: str, late: str) -> DataFrame:
    rows = stream.withWatermark(time, late) if stream.isStreaming else stream
    return rows.groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("n"))
