"""Incremental ingestion with Structured Streaming: every input file is taken once, restarts included."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

METRICS = "run string, epoch int, time double, map50 double, map50_95 double"


def follow_metrics(spark: SparkSession, folder: str, checkpoint: str, every: int, act: Callable[[DataFrame], None], once: bool = False, seconds: int = 20) -> StreamingQuery:
    """Calls `act` with the new rows of every `every`th epoch as result files arrive; `once`: with what is there."""
    rows = spark.readStream.schema(METRICS).option("header", "true").csv(folder).where(F.col("epoch") % every == 0)

    def batch(df: DataFrame, _: int) -> None:
        act(df)

    w = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=f"{seconds} seconds")).start()


def incremental(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], once: bool = True) -> StreamingQuery:
    """Appends transform(new rows) of Parquet files to a Parquet table, exactly once per file."""
    new = transform(spark.readStream.schema(schema).parquet(folder))
    w = new.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if once else w).start()


def idle_runs(rows: DataFrame, minutes: int = 5) -> DataFrame:
    """Per run and quiet spell the epochs seen: a run is over once nothing came for `minutes` (session window on `at`)."""
    return rows.withWatermark("at", f"{minutes} minutes").groupBy(F.session_window("at", f"{minutes} minutes"), "run").agg(F.max("epoch").alias("last_epoch"), F.count(F.lit(1)).alias("n"))
