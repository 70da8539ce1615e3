"""Root-cause operators over long attribution tables.

A long attribution table has one row per (unit, sensor) with a signed value
in log-odds space (positive pushes toward fail). Top-N selection uses
``row_number() <= n``; Catalyst plans it with a partial ``WindowGroupLimit``
before the shuffle, so a unit with very many rows is cut to ``n`` rows per
input partition before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import small_side


def top_n_per_unit(
    long_df: DataFrame,
    unit_col: str,
    value_col: str,
    n: int,
    tie_cols: Sequence[str] = (),
    rank_col: str = "Rank",
) -> DataFrame:
    """Rows with the ``n`` largest ``|value|`` per unit, ranked 1..n.

    Ties in ``|value|`` are broken by ``tie_cols`` and then by the signed
    value, so the result does not depend on row arrival order.
    """
    order = [F.abs(F.col(value_col)).desc()] + [F.col(c).asc() for c in tie_cols]
    order.append(F.col(value_col).asc())
    w = Window.partitionBy(unit_col).orderBy(*order)
    ranked = long_df.withColumn(rank_col, F.row_number().over(w))
    return ranked.filter(F.col(rank_col) <= n).withColumn(rank_col, F.col(rank_col).cast("int"))


def top_sensors_per_failure(
    attributions: DataFrame,
    predictions: DataFrame,
    top_n: int = 3,
    unit_col: str = "Wafer_ID",
    sensor_col: str = "Sensor_Name",
    value_col: str = "SHAP_Value",
    tie_cols: Sequence[str] = ("sensor_no",),
) -> DataFrame:
    """For every unit predicted to fail, its ``top_n`` sensors by |value|.

    Output has the fixed root-cause schema (``Wafer_ID, Timestamp,
    Sensor_Name, SHAP_Value, Rank``) even when nothing is predicted to fail.
    """
    fails = predictions.filter(F.col("Predicted_Class") == 1).select(unit_col, "Timestamp")
    scored = attributions.join(fails, unit_col, "inner")
    ties = [c for c in tie_cols if c in attributions.columns]
    top = top_n_per_unit(scored, unit_col, value_col, top_n, ties)
    return top.select(
        F.col(unit_col).alias("Wafer_ID"),
        F.col("Timestamp").cast("timestamp_ntz").alias("Timestamp"),
        F.col(sensor_col).alias("Sensor_Name"),
        F.round(F.col(value_col).cast("double"), 6).alias("SHAP_Value"),
        F.col("Rank"),
    )


def recurring_sensors(rca: DataFrame, limit: int = 10) -> DataFrame:
    """Sensors that appear most often among root causes, with the signed mean
    attribution; ties in the count by name."""
    return (
        rca.groupBy("Sensor_Name")
        .agg(
            F.count(F.lit(1)).alias("Appearances"),
            F.avg("SHAP_Value").alias("_mean"),
        )
        .orderBy(F.desc("Appearances"), F.asc("Sensor_Name"))
        .limit(limit)
        .select("Sensor_Name", "Appearances", F.round("_mean", 9).alias("Mean_SHAP"))
    )


def global_importance(
    attributions: DataFrame,
    n_units: int | None = None,
    top: int = 20,
    unit_col: str = "Wafer_ID",
    sensor_col: str = "Sensor_Name",
    value_col: str = "SHAP_Value",
) -> DataFrame:
    """Mean |attribution| per sensor over all explained units, top ``top``.

    Sensors absent for a unit count as zero (sparse tables omit exact zeros):
    the mean divides by the number of explained units.
    """
    per_sensor = attributions.groupBy(sensor_col).agg(
        F.sum(F.abs(F.col(value_col))).alias("_s")
    )
    if n_units is None:
        denom = attributions.select(F.count_distinct(unit_col)).scalar()
    else:
        denom = F.lit(n_units)
    return (
        per_sensor.withColumn("_m", F.col("_s") / denom.cast("double"))
        .orderBy(F.desc("_m"), F.asc(sensor_col))
        .limit(top)
        .select(
            F.col(sensor_col).alias("Sensor_Name"),
            F.round("_m", 9).alias("Mean_Abs_SHAP"),
        )
    )


def unit_waterfall(
    attributions: DataFrame,
    base_value: float = 0.0,
    max_display: int = 15,
    unit_col: str = "Wafer_ID",
    sensor_col: str = "Sensor_Name",
    value_col: str = "SHAP_Value",
    tie_cols: Sequence[str] = ("sensor_no",),
) -> DataFrame:
    """Data behind a per-unit waterfall: the ``max_display - 1`` largest
    |attributions| one by one, the rest folded into one "other" row, and the
    running total from the base value (bottom of the waterfall = "other").

    Columns: unit, Position (1 = largest), Feature, SHAP_Value, Cumulative.
    ``Cumulative`` at position 1 equals base + sum of all attributions.
    The fold uses a per-unit total (partial aggregation) minus the shown
    rows, so no unit is ever sorted whole in one task.
    """
    shown = max_display - 1
    ties = [c for c in tie_cols if c in attributions.columns]
    top = top_n_per_unit(attributions, unit_col, value_col, shown, ties, "Position")
    totals = attributions.groupBy(unit_col).agg(
        F.sum(value_col).alias("_total"), F.count(F.lit(1)).alias("_n")
    )
    top_sum = top.groupBy(unit_col).agg(
        F.sum(value_col).alias("_shown"), F.count(F.lit(1)).alias("_k")
    )
    other = (
        totals.join(top_sum, unit_col)
        .filter(F.col("_n") > F.col("_k"))
        .select(
            unit_col,
            F.lit(max_display).alias("Position"),
            F.format_string("%d other features", F.col("_n") - F.col("_k")).alias("Feature"),
            (F.col("_total") - F.col("_shown")).alias(value_col),
        )
    )
    rows = top.select(
        unit_col, "Position", F.col(sensor_col).alias("Feature"), F.col(value_col).cast("double")
    ).unionByName(other)
    # Position ascending is the top of the chart; the running total is taken
    # from the bottom (largest Position) upward.
    w = Window.partitionBy(unit_col).orderBy(F.desc("Position")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    return rows.select(
        unit_col,
        F.col("Position").cast("int").alias("Position"),
        "Feature",
        F.round(value_col, 9).alias("SHAP_Value"),
        F.round(F.lit(base_value) + F.sum(value_col).over(w), 9).alias("Cumulative"),
    )


def linear_attribution(
    features_long: DataFrame,
    coefficients: DataFrame,
    unit_col: str = "unit_no",
    sensor_col: str = "sensor_no",
    value_col: str = "value",
) -> DataFrame:
    """Exact attributions of a linear (logistic) model in log-odds space:
    ``coef_j * (x_j - mean_j)``; the base value is the intercept plus
    ``sum_j coef_j * mean_j``. ``coefficients`` has ``sensor_col, coef``.
    """
    means = features_long.groupBy(sensor_col).agg(F.avg(value_col).alias("_mean"))
    params = small_side(coefficients.join(means, sensor_col, "inner"), "coefficients")
    return features_long.join(params, sensor_col, "inner").select(
        unit_col,
        sensor_col,
        (F.col("coef") * (F.col(value_col) - F.col("_mean"))).alias("attribution"),
    )
