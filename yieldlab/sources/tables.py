"""Table sinks and sources (Parquet), and the production-log table.

Outputs are written with the parallel Parquet writer, partitioned by
production date where a time column exists, so readers prune by date and
push filters into the scan. Timestamps stay typed (TIMESTAMP_NTZ), never
text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import sanitize_columns, unit_id_from_index
from ..operators.cleaning import to_wide

DATE_PART = "Production_Date"


def write_table(
    df: DataFrame,
    path: str,
    partition_by_date: str | None = "Timestamp",
    mode: str = "overwrite",
) -> None:
    """Write Parquet; with a time column, partition by its calendar date."""
    out = df
    if partition_by_date and partition_by_date in df.columns:
        out = df.withColumn(DATE_PART, F.to_date(partition_by_date))
        # A day's rows together (large days split by adaptive execution), so that
        # tasks x days small files don't arise.
        out = out.hint("rebalance", F.col(DATE_PART))
        out.write.mode(mode).partitionBy(DATE_PART).parquet(path)
    else:
        out.write.mode(mode).parquet(path)


def read_table(spark: SparkSession, path: str, keep_date: bool = False) -> DataFrame:
    """Read a table written by ``write_table``, without the partition column
    unless ``keep_date``: with it, a filter on the date skips whole folders."""
    df = spark.read.parquet(path)
    return df.drop(DATE_PART) if DATE_PART in df.columns and not keep_date else df


def drop_autoincrement(df: DataFrame, col: str = "id") -> DataFrame:
    return df.drop(col) if col in df.columns else df


def production_logs(
    clean_long: DataFrame,
    units: DataFrame,
    sensors: Sequence,
    unit_col: str = "unit_no",
    sensor_col: str = "sensor_no",
    value_col: str = "value",
) -> DataFrame:
    """Wide production log: ``Wafer_ID, Timestamp, Label`` and one column per
    kept sensor (names sanitised). Labels attach by key, not by position.

    ``units`` has ``unit_col`` (0-based position), ``Timestamp``, ``Label``.
    """
    names = [f"Sensor_{s}" for s in sensors]
    wide = to_wide(clean_long, [unit_col], sensors, sensor_col, value_col, names)
    logs = units.join(wide, unit_col, "inner")
    cols = ["Wafer_ID", "Timestamp", "Label"] + sanitize_columns(names)
    return logs.withColumn("Wafer_ID", unit_id_from_index(F.col(unit_col))).select(*cols)
