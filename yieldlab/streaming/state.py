"""Daily yield KPIs kept in streaming state, exact and restart-safe.

A key is a day and a part of its units (by a hash of the unit), so that one
large day is spread over ``PARTS`` keys. Each key's state is a value (counts
and sums) and a list of the units seen, which makes the distinct count exact.
Every micro-batch emits the new totals of the keys that it touched; they
replace, folder by folder, what stood there before. Totals, not increments, are
written, so a batch that is repeated after a failure changes nothing, and there
are never more files than days and parts.

A day closes when the watermark passes its end: a timer emits its last totals
marked ``closed`` and drops its state. Rows that come later than that are left
out and counted (``late_rows``).
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.columns import safe_pct
from ..session import ensure_checkpoint_dir
from .kpis import stream_events_predictions

#: Keys of a day.
PARTS = 8
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOTALS = "Production_Date date, part int, units long, n long, actual long, predicted long, p double, n_p long, closed boolean"
SUMS = "n long, actual long, predicted long, p double, n_p long, n_units long"


class DayPart(StatefulProcessor):
    """State of one day's part of the units."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", SUMS)
        self.units = handle.getListState("units", "unit string")

    def _row(self, key: tuple, sums: tuple, closed: bool) -> pd.DataFrame:
        n, actual, predicted, p, n_p, n_units = sums
        return pd.DataFrame({
            "Production_Date": [key[0]], "part": [key[1]], "units": [n_units], "n": [n], "actual": [actual],
            "predicted": [predicted], "p": [p], "n_p": [n_p], "closed": [closed],
        })

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, actual, predicted, p, n_p, n_units = self.sums.get() if self.sums.exists() else (0, 0, 0, 0.0, 0, 0)
        if not n and not n_units:
            end = pd.Timestamp(key[0]) + pd.Timedelta(days=1)
            self.handle.registerTimer(int(end.value // 1_000_000))
        seen = {u for (u,) in self.units.get()} if n_units else set()
        new: set[str] = set()
        for pdf in rows:
            ids = pdf["unit"].dropna()
            n += len(ids)
            new.update(u for u in ids.unique() if u not in seen)
            actual += int(pdf["actual"].sum())
            predicted += int(pdf["predicted"].sum())
            known = pdf["p"].dropna()
            p += float(known.sum())
            n_p += len(known)
        if new:
            self.units.appendList([(u,) for u in sorted(new)])
        sums = (n, actual, predicted, p, n_p, n_units + len(new))
        self.sums.update(sums)
        yield self._row(key, sums, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.sums.exists():
            yield self._row(key, self.sums.get(), True)
        self.sums.clear()
        self.units.clear()

    def close(self) -> None:
        pass


def day_totals(predictions: DataFrame, lateness: str = "1 day", parts: int = PARTS) -> DataFrame:
    """Streaming predictions -> totals of the touched keys, in update mode.
    Rows without a time belong to no day and are left out."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    failed = F.when(F.col("Predicted_Class") == 1, F.col("Failure_Probability"))
    unit = F.col("Wafer_ID").cast("string")
    rows = predictions.select(
        F.col("Timestamp").cast("timestamp").alias("at"), F.to_date("Timestamp").alias("Production_Date"),
        F.pmod(F.xxhash64(unit), F.lit(parts)).cast("int").alias("part"), unit.alias("unit"),
        F.coalesce(F.col("Actual_Result").cast("long"), F.lit(0)).alias("actual"),
        F.coalesce(F.col("Predicted_Class").cast("long"), F.lit(0)).alias("predicted"), failed.alias("p"),
    ).filter(F.col("at").isNotNull())
    keyed = rows.withWatermark("at", lateness).groupBy("Production_Date", "part")
    return keyed.transformWithStateInPandas(DayPart(), TOTALS, "Update", "EventTime")


def keep_totals(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start the stream over all available input: ``path`` holds the latest
    totals of every key, in a folder of its own. A later call with the same
    ``checkpoint`` goes on where the last one stopped."""
    spark = totals.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)

    def replace(batch: DataFrame, number: int) -> None:
        # a day that is touched and closed in the same batch has two rows
        latest = batch.groupBy("Production_Date", "part").agg(F.max_by(F.struct(*batch.columns[2:]), F.struct("n", "closed")).alias("t"))
        rows = latest.select("Production_Date", "part", "t.*")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("Production_Date", "part").parquet(path)

    writer = totals.writeStream.outputMode("update").foreachBatch(replace).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after their day had closed, in the batches that the
    query still remembers."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])


def kpis_from_totals(spark: SparkSession, path: str) -> DataFrame:
    """The batch view's columns from the latest totals, and whether a day is
    closed (no more rows can change it)."""
    totals = spark.read.schema(TOTALS).parquet(path)
    n = F.sum("n")
    return totals.groupBy("Production_Date").agg(
        F.sum("units").alias("Total_Wafers"),
        F.sum("actual").alias("Actual_Failures"),
        safe_pct(F.sum("actual"), n, 2).alias("Actual_Defect_Rate_Pct"),
        F.sum("predicted").alias("Predicted_Failures"),
        safe_pct(F.sum("predicted"), n, 2).alias("Predicted_Defect_Rate_Pct"),
        F.round(F.try_divide(F.sum("p"), F.sum("n_p")), 4).alias("Avg_Failure_Probability"),
        F.bool_and("closed").alias("Closed"),
    )


def run_state_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, run until all available input is
    processed; the KPIs of every day, closed or not."""
    base = os.path.join(ensure_checkpoint_dir(spark), f"state-kpis-{uuid.uuid4().hex}")
    query = keep_totals(day_totals(stream_events_predictions(spark, sf_dir)), f"{base}/totals", f"{base}/state")
    query.awaitTermination()
    return kpis_from_totals(spark, f"{base}/totals").drop("Closed")
