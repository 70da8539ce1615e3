"""Rolling statistics over a stream, in event-time order, without one task
for the whole order.

Time is cut into slices of equal width, which are the keys. A slice's state
is its reorder buffer: the rows that have come so far, in any order. Every
micro-batch emits the slices that it touched, whole; they are ordered, get
their rolling mean and spread by a window over the slice, and replace, folder
by folder, what stood there before. So a batch that is repeated after a
failure changes nothing, and rows may come late as long as their slice is open.

The first ``rows - 1`` rows of a slice need rows of earlier slices. Their
number doesn't grow with the slices' size: ``rolling_rows`` takes the first
and the last ``rows - 1`` rows of all slices as one short ordered table, rolls
over that once more, and takes the first rows' statistics from it. Between two
slices' first rows this short table has no gap, whatever the slices' sizes.

A slice closes when the watermark passes its end: a timer marks it closed and
drops its buffer. Rows that come later are left out and counted by the stream.
One task holds a slice at a time, so its width is chosen for the rate of rows.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.ordering import rolling_stats
from ..plans.views import top_sensor
from ..session import ensure_checkpoint_dir
from .kpis import stream_events_predictions
from .state import STORE

DAY = 86_400
ROWS = 5
KEEP = ["Predicted_Class", "Actual_Result"]


class Slice(StatefulProcessor):
    """The rows of one slice, as texts, in blocks as they came."""

    def __init__(self, width: int, names: list[str]):
        self.width, self.names = width, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.blocks = handle.getListState("blocks", "block binary")

    def _out(self, key: tuple, rows: pd.DataFrame, closed: bool) -> pd.DataFrame:
        return rows.assign(slice=key[0], closed=closed)[["slice", "closed", *self.names]]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kind = pa.schema([(c, pa.string()) for c in self.names])
        if not self.blocks.exists():
            self.handle.registerTimer((key[0] + 1) * self.width * 1000)
        new = []
        for pdf in rows:
            batch = pa.RecordBatch.from_pandas(pdf[self.names], kind, preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, kind) as writer:
                writer.write_batch(batch)
            new.append((sink.getvalue().to_pybytes(),))
        if new:
            self.blocks.appendList(new)
        for (block,) in self.blocks.get():
            yield self._out(key, pa.ipc.open_stream(block).read_pandas(), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.blocks.clear()
        yield self._out(key, pd.DataFrame({c: [None] for c in self.names}, dtype=object), True)

    def close(self) -> None:
        pass


def _schema(stream: DataFrame, time_col: str, id_col: str, value_col: str, keep: Sequence[str]) -> T.StructType:
    fields = [stream.schema[c] for c in (time_col, id_col, value_col, *keep)]
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def buffered(
    stream: DataFrame, time_col: str, id_col: str, value_col: str, keep: Sequence[str] = (), width: int = DAY, lateness: str = "1 day"
) -> DataFrame:
    """The touched slices of a stream, in update mode: ``slice``, ``closed``
    and the columns as texts. Rows without a time have no slice and are left
    out; nulls elsewhere and repeated rows stay. Slices are ``width`` seconds."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    names = [time_col, id_col, value_col, *keep]
    texts = [f"c{i}" for i in range(len(names))]
    at = F.col(time_col).cast("timestamp")
    rows = stream.filter(F.col(time_col).isNotNull()).select(
        at.alias("at"),
        F.floor(F.unix_micros(at) / F.lit(width * 1_000_000)).cast("long").alias("slice"),
        *[F.col(c).cast("string").alias(t) for c, t in zip(names, texts)],
    )
    kind = "slice long, closed boolean, " + ", ".join(f"{t} string" for t in texts)
    keyed = rows.withWatermark("at", lateness).groupBy("slice")
    return keyed.transformWithStateInPandas(Slice(width, texts), kind, "Update", "EventTime")


def _order(names: Sequence[str]) -> list[Column]:
    """Time, id, and then all other columns, so that ties fall alike everywhere."""
    return [F.col(c) for c in names]


def keep_slices(
    stream: DataFrame, path: str, checkpoint: str, time_col: str, id_col: str, value_col: str,
    keep: Sequence[str] = (), rows: int = ROWS, width: int = DAY, lateness: str = "1 day",
) -> StreamingQuery:
    """Start the stream over all available input: ``path`` holds every slice's
    rows with their statistics inside the slice. A later call with the same
    ``checkpoint`` goes on where the last one stopped."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    schema = _schema(stream, time_col, id_col, value_col, keep)
    table = T.StructType([*schema.fields, *_slice_fields(), *_key_fields()])
    spark.createDataFrame([], table).write.mode("append").partitionBy("slice", "closed").parquet(path)

    def replace(batch: DataFrame, number: int) -> None:
        typed = batch.select("slice", "closed", *[F.col(f"c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])
        own = Window.partitionBy("slice", "closed")
        order = _order(schema.names)
        frame = own.orderBy(*order).rowsBetween(-(rows - 1), 0)
        x = F.col(value_col).cast("double")
        mean = F.avg(x).over(frame)
        spread = F.sqrt(F.greatest(F.avg(x * x).over(frame) - mean * mean, F.lit(0.0)))
        place = F.row_number().over(own.orderBy(*order))
        out = typed.select(
            *schema.names, mean.alias("_mean"), spread.alias("_std"), (place < rows).alias("_head"),
            (place > F.count("*").over(own) - (rows - 1)).alias("_tail"), "slice", "closed",
        )
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slice", "closed").parquet(path)

    writer = buffered(stream, time_col, id_col, value_col, keep, width, lateness).writeStream
    writer = writer.outputMode("update").foreachBatch(replace).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _slice_fields() -> list[T.StructField]:
    kinds = {"_mean": T.DoubleType(), "_std": T.DoubleType(), "_head": T.BooleanType(), "_tail": T.BooleanType()}
    return [T.StructField(c, t) for c, t in kinds.items()]


def _key_fields() -> list[T.StructField]:
    return [T.StructField("slice", T.LongType()), T.StructField("closed", T.BooleanType())]


def slices(spark: SparkSession, path: str) -> DataFrame:
    """What ``keep_slices`` wrote; a closed slice has one more row, of nulls."""
    found = spark.read.parquet(path).schema if _has_rows(spark, path) else None
    if found is None:
        raise ValueError(f"no slice has been written to {path}")
    own = [f for f in found.fields if f.name not in ("slice", "closed")]
    return spark.read.schema(T.StructType([*own, *_key_fields()])).parquet(path)


def _has_rows(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(folder) and any(s.isDirectory() and s.getPath().getName().startswith("slice=") for s in fs.listStatus(folder))


def closed_slices(spark: SparkSession, path: str) -> DataFrame:
    """The slices that no row can change any more."""
    return slices(spark, path).filter("closed").select("slice")


def rolling_rows(spark: SparkSession, path: str, rows: int = ROWS) -> DataFrame:
    """All rows with ``_mean`` and ``_std`` over the current row and the
    ``rows - 1`` before it; ``rows`` is that of ``keep_slices``."""
    table = slices(spark, path).filter("not closed").drop("slice", "closed")
    names = [c for c in table.columns if c not in ("_mean", "_std", "_head", "_tail")]
    inner = table.filter("not _head").select(*names, "_mean", "_std")
    edges = table.filter("_head or _tail").select(*names, "_head")
    value = F.col(names[2]).cast("double")
    again = rolling_stats(edges.withColumn("_value", value), _order(names), "_value", rows=rows, mean_col="_mean", std_col="_std")
    return inner.unionByName(again.filter("_head").select(*names, "_mean", "_std"))


def keep_stability(
    predictions: DataFrame, production_logs: DataFrame, path: str, checkpoint: str, width: int = DAY, lateness: str = "1 day"
) -> StreamingQuery:
    """The rows behind the stability view from a stream of predictions. A
    prediction's time is that of its unit's row in the production log, which
    must be there when the prediction comes; without one it is left out, as
    in the view."""
    logs = production_logs.select("Wafer_ID", "Timestamp")
    joined = predictions.select("Wafer_ID", *KEEP, "Failure_Probability").join(logs, "Wafer_ID")
    return keep_slices(joined, path, checkpoint, "Timestamp", "Wafer_ID", "Failure_Probability", KEEP, ROWS, width, lateness)


def stability_from_slices(spark: SparkSession, path: str, rca: DataFrame) -> DataFrame:
    """The columns of ``plans.views.process_stability``; the monitored sensor
    is that of the attributions as they are now (none: no rows, as there)."""
    monitored = top_sensor(rca).select("Sensor_Name").scalar()
    rolled = rolling_rows(spark, path).withColumn("Monitored_Sensor", monitored).filter(F.col("Monitored_Sensor").isNotNull())
    return rolled.select(
        "Wafer_ID",
        "Timestamp",
        F.to_date("Timestamp").alias("Production_Date"),
        "Predicted_Class",
        "Failure_Probability",
        "Actual_Result",
        "Monitored_Sensor",
        F.round("_mean", 4).alias("Rolling5_Avg_Fail_Prob"),
        F.round("_std", 6).alias("Rolling5_StdDev_Fail_Prob"),
    )


def run_stream_stability(spark: SparkSession, sf_dir: str, production_logs: DataFrame, rca: DataFrame) -> DataFrame:
    """The events table as a stream, run until all available input is processed."""
    base = os.path.join(ensure_checkpoint_dir(spark), f"state-stability-{uuid.uuid4().hex}")
    query = keep_stability(stream_events_predictions(spark, sf_dir), production_logs, f"{base}/slices", f"{base}/state")
    query.awaitTermination()
    return stability_from_slices(spark, f"{base}/slices", rca)
