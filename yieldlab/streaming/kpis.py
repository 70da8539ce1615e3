"""Daily yield KPIs maintained incrementally with Structured Streaming.

The batch view (``plans.views.yield_kpis``) recomputes every day; here each
micro-batch of predictions updates one-day event-time windows, and the
watermark bounds the state: a day is final (emitted in append mode) once the
watermark passes its end. Exact distinct counts are not available in
streaming aggregations, so ``Total_Wafers`` is an HLL++ estimate; the other
columns equal the batch view.

``stream_partials`` is exact: each micro-batch leaves one row per day and
unit with its sums and counts, in a folder of its own that a repeated batch
overwrites, and ``kpis_from_partials`` adds them up. Every day is there as
soon as its first row is.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import safe_pct
from ..session import ensure_checkpoint_dir


def stream_yield_kpis(predictions: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Streaming (or batch) predictions -> per-day KPI rows."""
    n_ids = F.count("Wafer_ID")
    # Watermarks need an instant (TIMESTAMP); the session time zone is UTC
    # (see session.get_session), so the cast keeps the wall clock and the
    # one-day windows are calendar days.
    timed = predictions.withColumn("_event_time", F.col("Timestamp").cast("timestamp"))
    agg = (
        timed.withWatermark("_event_time", watermark)
        .groupBy(F.window("_event_time", "1 day").alias("day"))
        .agg(
            F.approx_count_distinct("Wafer_ID", 0.01).alias("Total_Wafers"),
            F.sum(F.col("Actual_Result").cast("long")).alias("Actual_Failures"),
            safe_pct(F.sum("Actual_Result"), n_ids, 2).alias("Actual_Defect_Rate_Pct"),
            F.sum(F.col("Predicted_Class").cast("long")).alias("Predicted_Failures"),
            safe_pct(F.sum("Predicted_Class"), n_ids, 2).alias("Predicted_Defect_Rate_Pct"),
            F.round(
                F.avg(F.when(F.col("Predicted_Class") == 1, F.col("Failure_Probability"))), 4
            ).alias("Avg_Failure_Probability"),
        )
    )
    return agg.select(F.to_date(F.col("day.start")).alias("Production_Date"), *agg.columns[1:])


def stream_events_predictions(spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """The events adapter as a file stream (new Parquet files are new rows);
    the caller may bound the files of a micro-batch."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    events = reader.parquet(sf_dir)
    return events.select(
        F.col("event_id").alias("Wafer_ID"),
        F.col("ts").alias("Timestamp"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("Actual_Result"),
        F.when(F.col("value") >= 120, 1).otherwise(0).alias("Predicted_Class"),
        (F.col("value") / (F.col("value") + F.lit(50.0))).alias("Failure_Probability"),
    )


def start_to_path(
    kpis: DataFrame, path: str, checkpoint: str | None = None, available_now: bool = True
) -> StreamingQuery:
    """Append finalised days as Parquet files under ``path``. The stream's
    own checkpoint lives in the shared checkpoint folder unless given, so a
    restarted query resumes where it stopped."""
    spark = kpis.sparkSession
    if checkpoint is None:
        checkpoint = os.path.join(ensure_checkpoint_dir(spark), f"stream-{uuid.uuid4().hex}")
    writer = (
        kpis.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stream_partials(predictions: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start the exact form: partial sums of each micro-batch under ``path``."""
    failed = F.when(F.col("Predicted_Class") == 1, F.col("Failure_Probability"))

    def leave(batch: DataFrame, number: int) -> None:
        parts = batch.groupBy(F.to_date("Timestamp").alias("Production_Date"), "Wafer_ID").agg(
            F.count("Wafer_ID").alias("n"),
            F.sum(F.col("Actual_Result").cast("long")).alias("actual"),
            F.sum(F.col("Predicted_Class").cast("long")).alias("predicted"),
            F.sum(failed).alias("p"),
            F.count(failed).alias("n_p"),
        )
        parts.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = predictions.writeStream.foreachBatch(leave).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def kpis_from_partials(partials: DataFrame) -> DataFrame:
    """Partial rows -> the batch view's columns; units are counted exactly."""
    sums = ["n", "actual", "predicted", "p", "n_p"]
    units = partials.groupBy("Production_Date", "Wafer_ID").agg(*[F.sum(c).alias(c) for c in sums])
    n = F.sum("n")
    return units.groupBy("Production_Date").agg(
        F.count("Wafer_ID").alias("Total_Wafers"),
        F.sum("actual").alias("Actual_Failures"),
        safe_pct(F.sum("actual"), n, 2).alias("Actual_Defect_Rate_Pct"),
        F.sum("predicted").alias("Predicted_Failures"),
        safe_pct(F.sum("predicted"), n, 2).alias("Predicted_Defect_Rate_Pct"),
        F.round(F.try_divide(F.sum("p"), F.sum("n_p")), 4).alias("Avg_Failure_Probability"),
    )


def run_stream_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the exact stream over the events table until all available input
    is processed, and return the KPIs of every day."""
    base = os.path.join(ensure_checkpoint_dir(spark), f"stream-kpis-{uuid.uuid4().hex}")
    stream_partials(stream_events_predictions(spark, sf_dir), f"{base}/parts", f"{base}/state").awaitTermination()
    return kpis_from_partials(spark.read.parquet(f"{base}/parts"))
