"""Row identity and time helpers: unit ids from file position, gap filling
and an evenly spaced time axis. All rely on ``ordering.global_index``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import unit_id_from_index
from .ordering import IDX, fill_forward_backward, global_index


def assign_unit_id(
    df: DataFrame, order: Sequence[str | Column], id_col: str = "Wafer_ID"
) -> DataFrame:
    """``WAFER_%04d`` from the 1-based position in ``order``."""
    indexed, _ = global_index(df, order)
    return indexed.withColumn(id_col, unit_id_from_index(F.col(IDX))).drop(IDX)


def fill_timestamps(
    df: DataFrame, order: Sequence[str | Column], ts_col: str = "Timestamp"
) -> DataFrame:
    """Forward fill, then backward fill, of missing times in ``order``."""
    return fill_forward_backward(df, order, ts_col).drop(IDX)


def even_time_axis(
    df: DataFrame,
    order: Sequence[str | Column],
    end: str,
    span_days: int = 30,
    ts_col: str = "Timestamp",
) -> DataFrame:
    """``n`` evenly spaced times from ``end - span_days`` to ``end``.

    Position ``i`` of ``n`` gets ``start + floor(i * span / (n - 1))`` in
    integer microseconds (decimal arithmetic: no overflow, no float drift).
    A single row gets ``start``.
    """
    indexed, n = global_index(df, order)
    span_us = span_days * 86_400_000_000
    end_ts = F.lit(end).cast("timestamp_ntz")
    start = F.timestamp_add("DAY", F.lit(-span_days), end_ts)
    if n <= 1:
        offset = F.lit(0).cast("long")
    else:
        prod = F.col(IDX).cast("decimal(38,0)") * F.lit(span_us).cast("decimal(38,0)")
        offset = F.floor(prod / F.lit(n - 1).cast("decimal(38,0)")).cast("long")
    return indexed.withColumn(ts_col, F.timestamp_add("MICROSECOND", offset, start)).drop(IDX)
