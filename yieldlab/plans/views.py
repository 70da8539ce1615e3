"""The analytical views (daily yield KPIs, high-risk sensors, process
stability, failure drill-down) plus +-3 sigma control limits.

Inputs use the reference's table schemas:

* predictions: ``Wafer_ID, Timestamp, Actual_Result, Predicted_Class,
  Failure_Probability``
* rca (root cause): ``Wafer_ID, Timestamp, Sensor_Name, SHAP_Value, Rank``
* production logs: ``Wafer_ID, Timestamp, Label, <sensor columns>``

The daily KPIs and the failure drill-down are lazy DataFrames; the ranked and
the rolling view stage their ordered input once. ``register_views`` exposes
them to SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import safe_pct, shap_direction
from ..operators.ordering import global_rank, rolling_stats
from ..session import small_side
from ..sources.tables import DATE_PART, read_table

YIELD_KPI_COLUMNS = [
    "Production_Date",
    "Total_Wafers",
    "Actual_Failures",
    "Actual_Defect_Rate_Pct",
    "Predicted_Failures",
    "Predicted_Defect_Rate_Pct",
    "Avg_Failure_Probability",
]


def yield_kpis(predictions: DataFrame) -> DataFrame:
    """Per production day: wafers, actual/predicted failures and rates, and the
    mean probability over that day's predicted failures (NULL if none).

    The rate denominator is ``COUNT(Wafer_ID)`` (non-NULL ids), not the
    distinct count, as in the reference.
    """
    p = predictions
    n_ids = F.count("Wafer_ID")
    return p.groupBy(F.to_date("Timestamp").alias("Production_Date")).agg(
        F.count_distinct("Wafer_ID").alias("Total_Wafers"),
        F.sum(F.col("Actual_Result").cast("long")).alias("Actual_Failures"),
        safe_pct(F.sum("Actual_Result"), n_ids, 2).alias("Actual_Defect_Rate_Pct"),
        F.sum(F.col("Predicted_Class").cast("long")).alias("Predicted_Failures"),
        safe_pct(F.sum("Predicted_Class"), n_ids, 2).alias("Predicted_Defect_Rate_Pct"),
        F.round(
            F.avg(F.when(F.col("Predicted_Class") == 1, F.col("Failure_Probability"))), 4
        ).alias("Avg_Failure_Probability"),
    )


def recent_window(rca: DataFrame, days: int = 7) -> DataFrame:
    """Rows whose calendar day is within ``days`` days of the table's latest
    timestamp (inclusive by date, so up to ``days + 1`` calendar days).

    The anchor is an uncorrelated scalar subquery, run once by Catalyst. A
    table that carries its date partition is pruned by it as well.
    """
    anchor = rca.select(F.max("Timestamp")).scalar()
    first_day = F.date_sub(F.to_date(anchor), days)
    # The bare column on one side, so that the filter reaches the scan.
    recent = rca.filter(F.col("Timestamp") >= first_day)
    return recent.filter(F.col(DATE_PART) >= first_day) if DATE_PART in rca.columns else recent


def high_risk_sensors(rca: DataFrame, days: int = 7) -> DataFrame:
    """Sensors ranked by total |attribution| over the recent window.

    ``Impact_Rank`` is ``RANK()`` on the unrounded total; it is computed
    from running counts over the distinct totals, never in a single task.
    """
    recent = recent_window(rca, days)
    a = F.abs(F.col("SHAP_Value"))
    per_sensor = recent.groupBy("Sensor_Name").agg(
        F.count_distinct("Wafer_ID").alias("Affected_Wafers"),
        F.round(F.avg(a), 6).alias("Avg_Abs_SHAP"),
        F.round(F.max(a), 6).alias("Max_Abs_SHAP"),
        F.sum(a).alias("_impact"),
        F.count(F.lit(1)).alias("Total_Appearances"),
    )
    ranked = global_rank(per_sensor, "_impact", "Impact_Rank")
    return ranked.select(
        "Sensor_Name",
        "Affected_Wafers",
        "Avg_Abs_SHAP",
        "Max_Abs_SHAP",
        F.round("_impact", 6).alias("Total_SHAP_Impact"),
        "Total_Appearances",
        F.col("Impact_Rank").cast("int").alias("Impact_Rank"),
    )


def top_sensor(rca: DataFrame) -> DataFrame:
    """The single sensor with the largest total |attribution| over all time
    (ties broken by name). A global top-1: each task keeps its local best."""
    return (
        rca.groupBy("Sensor_Name")
        .agg(F.round(F.sum(F.abs("SHAP_Value")), 6).alias("Total_Abs_SHAP"),
             F.sum(F.abs("SHAP_Value")).alias("_t"))
        .orderBy(F.desc("_t"), F.asc("Sensor_Name"))
        .limit(1)
        .drop("_t")
    )


def process_stability(
    production_logs: DataFrame,
    predictions: DataFrame,
    rca: DataFrame,
    rows: int = 5,
    readings: DataFrame | None = None,
) -> DataFrame:
    """Rolling ``rows``-wafer mean and population std of the failure
    probability in time order (ties by Wafer_ID), with the monitored sensor.

    The reference cross-joins with a one-row relation; here the sensor is a
    scalar subquery and an empty rca table gives zero rows, as there.
    With ``readings`` (``Wafer_ID, Sensor_Name, value`` in long form) the
    view also carries the monitored sensor's own reading as
    ``Monitored_Value`` (the reference leaves a placeholder there).
    """
    monitored = top_sensor(rca).select("Sensor_Name").scalar()
    joined = (
        production_logs.select("Wafer_ID", "Timestamp")
        .join(
            predictions.select(
                "Wafer_ID", "Predicted_Class", "Failure_Probability", "Actual_Result"
            ),
            "Wafer_ID",
            "inner",
        )
        .withColumn("Monitored_Sensor", monitored)
        .filter(F.col("Monitored_Sensor").isNotNull())
    )
    rolled = rolling_stats(
        joined,
        ["Timestamp", "Wafer_ID"],
        "Failure_Probability",
        rows=rows,
        mean_col="_m",
        std_col="_s",
    )
    out = rolled.select(
        "Wafer_ID",
        "Timestamp",
        F.to_date("Timestamp").alias("Production_Date"),
        "Predicted_Class",
        "Failure_Probability",
        "Actual_Result",
        "Monitored_Sensor",
        F.round("_m", 4).alias("Rolling5_Avg_Fail_Prob"),
        F.round("_s", 6).alias("Rolling5_StdDev_Fail_Prob"),
    )
    if readings is None:
        return out
    r = readings.select(
        "Wafer_ID",
        F.col("Sensor_Name").alias("Monitored_Sensor"),
        F.col("value").alias("Monitored_Value"),
    )
    return out.join(r, ["Wafer_ID", "Monitored_Sensor"], "left")


def failure_detail(predictions: DataFrame, rca: DataFrame) -> DataFrame:
    """Predicted failures left-joined to their ranked sensors."""
    fails = predictions.filter(F.col("Predicted_Class") == 1)
    r = rca.select("Wafer_ID", "Sensor_Name", "SHAP_Value", F.col("Rank").alias("Sensor_Rank"))
    return fails.join(r, "Wafer_ID", "left").select(
        "Wafer_ID",
        "Timestamp",
        "Actual_Result",
        "Predicted_Class",
        "Failure_Probability",
        "Sensor_Name",
        "SHAP_Value",
        "Sensor_Rank",
        shap_direction("SHAP_Value").alias("SHAP_Direction"),
    )


def control_limits(sensor_long: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Per sensor mean, sample std, mean -+ k*std and the number of readings
    outside the limits (the BI reference lines of the stability view)."""
    stats = sensor_long.groupBy("sensor_no").agg(
        F.count("value").alias("n_readings"),
        F.avg("value").alias("_mean"),
        F.stddev_samp("value").alias("_std"),
    )
    limits = stats.select(
        "sensor_no",
        "n_readings",
        "_mean",
        "_std",
        (F.col("_mean") - F.lit(sigmas) * F.col("_std")).alias("_lo"),
        (F.col("_mean") + F.lit(sigmas) * F.col("_std")).alias("_hi"),
    )
    limits = small_side(limits, "limits")
    out = sensor_long.join(limits, "sensor_no").groupBy(
        "sensor_no"
    ).agg(
        F.count_if((F.col("value") < F.col("_lo")) | (F.col("value") > F.col("_hi"))).alias(
            "n_out_of_limits"
        )
    )
    return limits.join(out, "sensor_no", "left").select(
        "sensor_no",
        "n_readings",
        F.round("_mean", 9).alias("mean"),
        F.round("_std", 9).alias("std"),
        F.round("_lo", 9).alias("lower_limit"),
        F.round("_hi", 9).alias("upper_limit"),
        F.coalesce("n_out_of_limits", F.lit(0).cast("long")).alias("n_out_of_limits"),
    )


# The reference's final ORDER BY of each view, with tie-breaks added so the
# order is total (Spark sorts with a range-partitioned, distributed sort).
VIEW_ORDER = {
    "v_yield_kpis": [("Production_Date", "asc")],
    "v_high_risk_sensors": [("Total_SHAP_Impact", "desc"), ("Sensor_Name", "asc")],
    "v_process_stability": [("Timestamp", "asc"), ("Wafer_ID", "asc")],
    "v_wafer_failure_detail": [
        ("Timestamp", "desc"), ("Failure_Probability", "desc"), ("Wafer_ID", "asc"),
        ("Sensor_Rank", "asc"),
    ],
}


def _sort_keys(name: str):
    return [F.asc(c) if d == "asc" else F.desc(c) for c, d in VIEW_ORDER[name]]


def register_views(
    spark: SparkSession,
    predictions: DataFrame,
    rca: DataFrame,
    production_logs: DataFrame,
    days: int = 7,
    ordered: bool = True,
) -> list[str]:
    """Register the base tables and the four views as temporary views
    (sorted as the reference's views are, unless ``ordered=False``).

    ``v_high_risk_sensors`` and ``v_process_stability`` read a table staged
    here; ``refresh_views`` brings them up to date."""
    predictions.createOrReplaceTempView("ml_predictions")
    rca.drop(DATE_PART).createOrReplaceTempView("root_cause_analysis")
    production_logs.createOrReplaceTempView("production_logs")
    views = {
        "v_yield_kpis": yield_kpis(predictions),
        "v_high_risk_sensors": high_risk_sensors(rca, days),
        "v_process_stability": process_stability(production_logs, predictions, rca),
        "v_wafer_failure_detail": failure_detail(predictions, rca),
    }
    for name, df in views.items():
        (df.orderBy(*_sort_keys(name)) if ordered else df).createOrReplaceTempView(name)
    return list(views)


def refresh_views(spark: SparkSession, tables_dir: str, days: int = 7, ordered: bool = True) -> list[str]:
    """Register the views again on the tables under ``tables_dir`` (written by
    ``write_table``) as they are now, rows appended since included."""
    base = {}
    for name in ("ml_predictions", "root_cause_analysis", "production_logs"):
        base[name] = read_table(spark, f"{tables_dir}/{name}", keep_date=name == "root_cause_analysis")
    return register_views(spark, *base.values(), days=days, ordered=ordered)
