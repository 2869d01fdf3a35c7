"""Result lines as a stream: files are checked as they arrive.

The same rules as in batch, except those that look at other lines (a repeated
id is told within a micro-batch only, and settled again by the batch check).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.contracts import check_verdicts


def line_stream(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(file, lineno, value) of files as they appear in ``folder``."""
    raw = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", pattern).load(folder)
    return raw.select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("_p", "value")).select("file", (F.col("_p") + 1).alias("lineno"), "value")


def verdict_sink(spark: SparkSession, folder: str, sent: DataFrame, out: str, checkpoint: str, pattern: str = "verify_*_result.jsonl"):
    """Starts the stream that checks verdict lines and appends them, with their
    errors, to a parquet table; ends when all files there are read."""

    def store(batch: DataFrame, batch_id: int) -> None:
        check_verdicts(batch, sent).withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    return line_stream(spark, folder, pattern).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
