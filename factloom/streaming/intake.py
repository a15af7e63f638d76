"""Streaming intake of responses and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factloom.operators.extract import accept

RESPONSES = "task_id string, fingerprint string, seq bigint, payload string"


def accept_stream(spark: SparkSession, responses: str, tasks: DataFrame, accepted: str, fingerprint: str, checkpoint: str) -> StreamingQuery:
    """Take JSON responses from a folder as they come. Every wave is an anti join with what was accepted,
    and a wave writes its own folder, so a replayed one changes nothing."""

    def wave(batch: DataFrame, epoch: int) -> None:
        try:
            done = spark.read.parquet(accepted).filter(F.col("wave") < epoch)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            done = spark.createDataFrame([], "task_id string")
        accept(batch, tasks, done, fingerprint).write.mode("overwrite").parquet(f"{accepted}/wave={epoch}")

    stream = spark.readStream.schema(RESPONSES).json(responses)
    return stream.writeStream.foreachBatch(wave).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """start, event_type, n, total of events (ts, event_type, value) in tumbling windows; works on streams,
    where rows later than ``late`` are left out, and on tables."""
    df = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if df.isStreaming:
        df = df.withWatermark("ts", late)
    out = df.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "total")
