"""Adapters that give the driver's test tables the shapes of the reference's
tables (see FIXTURES.md part C). Each has a DuckDB twin in ``oracle.py``.

* ``predictions``      C2: events -> ml_predictions
* ``sensor_long``      C1: embeddings -> long sensor readings with NULLs and
                       constant sensors injected
* ``unit_meta``        C1: unit time (``2024-01-01 + unit_no * 27 min``) and
                       label (``label = 0`` is fail)
* ``attributions``     C3: embeddings as a long signed attribution table
* ``rca``              C3: top-3 per unit of ``attributions`` with the unit's
                       event time
* ``label_lines``      C4: predictions rendered as label text lines
* ``sensor_lines``     C5: sensor readings rendered as text lines
* ``sensor_csv_lines``  the same as comma-separated lines, some of them bad
* ``gapped_times``     C6: predictions with NULL times injected
* ``orders_*``         larger scenario for scale: orders -> predictions,
                       lineitem -> attributions
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import sensor_name
from ..operators.attribution import top_n_per_unit

UNIT_EPOCH = "2024-01-01 00:00:00"
UNIT_STEP_MINUTES = 27


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("Wafer_ID"),
        F.col("ts").alias("Timestamp"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("Actual_Result"),
        F.when(F.col("value") >= 120, 1).otherwise(0).alias("Predicted_Class"),
        (F.col("value") / (F.col("value") + F.lit(50.0))).alias("Failure_Probability"),
    )


def production_logs_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimal production log keyed like ``predictions`` (id, time, label)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("Wafer_ID"),
        F.col("ts").alias("Timestamp"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("Label"),
    )


def sensor_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    x = emb.select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    value = (
        F.when(F.col("pos") % 16 == 0, F.lit(1.0))
        .when((F.col("vec_id") * 7 + F.col("pos") * 13) % 100 < F.col("pos"), F.lit(None))
        .otherwise(F.col("v").cast("double"))
    )
    return x.select(
        F.col("vec_id").alias("unit_no"),
        (F.col("pos") + 1).cast("int").alias("sensor_no"),
        value.cast("double").alias("value"),
    )


def unit_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").alias("unit_no"),
        F.timestamp_add(
            "MINUTE",
            F.col("vec_id") * UNIT_STEP_MINUTES,
            F.lit(UNIT_EPOCH).cast("timestamp_ntz"),
        ).alias("Timestamp"),
        F.when(F.col("label") == 0, 1).otherwise(0).alias("Label"),
    )


def attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    x = emb.select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    return x.select(
        F.col("vec_id").alias("Wafer_ID"),
        (F.col("pos") + 1).cast("int").alias("sensor_no"),
        sensor_name(F.col("pos") + 1).alias("Sensor_Name"),
        F.col("v").cast("double").alias("SHAP_Value"),
    )


def rca(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_n_per_unit(attributions(spark, sf_dir), "Wafer_ID", "SHAP_Value", 3, ["sensor_no"])
    times = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Wafer_ID"), F.col("ts").alias("Timestamp")
    )
    return top.join(times, "Wafer_ID", "inner").select(
        "Wafer_ID", "Timestamp", "Sensor_Name", "SHAP_Value", "Rank"
    )


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``-1 "dd/MM/yyyy HH:mm:ss"`` lines (every third one in the documented
    ``label HH:mm:ss dd-MM-yyyy`` form, every 13th with unreadable time, every
    11th with an unknown label ``0``), keyed by ``Wafer_ID`` for the check."""
    p = predictions(spark, sf_dir)
    wid = F.col("Wafer_ID")
    label_txt = (
        F.when(wid % 11 == 0, F.lit("0"))
        .when(F.col("Actual_Result") == 1, F.lit("1"))
        .otherwise(F.lit("-1"))
    )
    quoted = F.concat(F.lit('"'), F.date_format("Timestamp", "dd/MM/yyyy HH:mm:ss"), F.lit('"'))
    documented = F.date_format("Timestamp", "HH:mm:ss  dd-MM-yyyy")
    time_txt = (
        F.when(wid % 13 == 0, F.lit("not-a-time"))
        .when(wid % 3 == 0, documented)
        .otherwise(quoted)
    )
    return p.select("Wafer_ID", F.concat_ws(" ", label_txt, time_txt).alias("value"))


def sensor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text line per unit: readings in sensor order, NULL as ``NaN``."""
    s = sensor_long(spark, sf_dir)
    tok = F.coalesce(F.col("value").cast("string"), F.lit("NaN"))
    per_unit = s.groupBy("unit_no").agg(
        F.array_sort(F.collect_list(F.struct("sensor_no", tok.alias("t")))).alias("cells")
    )
    return per_unit.select(
        "unit_no",
        F.concat_ws("  ", F.transform("cells", lambda c: c["t"])).alias("value"),
    )


def sensor_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sensor_lines`` separated by commas. Every 5th unit has its fields in
    quotes, every 17th a field too many, every 19th an unreadable first one."""
    lines, unit = sensor_lines(spark, sf_dir), F.col("unit_no")
    fields = F.split("value", "  ")
    first = F.when(unit % 19 == 0, F.lit('x,"y')).otherwise(fields[0])
    fields = F.concat(F.array(first), F.slice(fields, 2, F.greatest(F.size(fields) - 1, F.lit(0))))
    quoted = F.transform(fields, lambda f: F.concat(F.lit('"'), F.regexp_replace(f, '"', '""'), F.lit('"')))
    fields = F.when((unit % 5 == 0) | (unit % 19 == 0), quoted).otherwise(fields)
    return lines.select("unit_no", F.concat(F.concat_ws(",", fields), F.when(unit % 17 == 0, F.lit(",7")).otherwise(F.lit(""))).alias("value"))


def gapped_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = predictions(spark, sf_dir)
    return p.select(
        "Wafer_ID",
        F.when(F.col("Wafer_ID") % 7 < 2, F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.col("Timestamp"))
        .alias("Timestamp"),
    )


# ---- larger scenario (orders / lineitem) ---------------------------------

ORDERS_FAIL_PRICE = 450000.0
ORDERS_PROB_SCALE = 100000.0


def orders_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    return o.select(
        F.col("o_orderkey").alias("Wafer_ID"),
        F.col("o_orderdate").alias("Timestamp"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("Actual_Result"),
        F.when(price >= F.lit(ORDERS_FAIL_PRICE), 1).otherwise(0).alias("Predicted_Class"),
        (price / (price + F.lit(ORDERS_PROB_SCALE))).alias("Failure_Probability"),
    )


def orders_production_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("Wafer_ID"),
        F.col("o_orderdate").alias("Timestamp"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("Label"),
    )


def lineitem_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("Wafer_ID"),
        F.col("l_suppkey").alias("sensor_no"),
        sensor_name(F.col("l_suppkey")).alias("Sensor_Name"),
        ((F.col("l_discount") - F.lit(0.05)) * F.col("l_quantity")).alias("SHAP_Value"),
    )


def lineitem_sensor_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long sensor readings at lineitem scale: unit ``l_orderkey``, sensor
    ``l_linenumber``; sensor 6 is mostly missing, sensor 7 constant, and
    quantities above 45 are missing readings (many tied values)."""
    li = table(spark, sf_dir, "lineitem")
    line, qty = F.col("l_linenumber"), F.col("l_quantity")
    value = (
        F.when((line == 6) & (qty > 10), F.lit(None))
        .when(qty > 45, F.lit(None))
        .when(line == 7, F.lit(1.0))
        .otherwise(F.col("l_extendedprice"))
    )
    return li.select(
        F.col("l_orderkey").alias("unit_no"),
        line.cast("int").alias("sensor_no"),
        value.cast("double").alias("value"),
    )
