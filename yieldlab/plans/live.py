"""Views that follow their tables: what a load appends is aggregated once, and
the SQL views merge the aggregates when they are read.

A load (``append_load``) has a name and brings predictions, attributions and
unit times. Its rows go to a folder of its own in each table, which a repeated
load replaces, and so do its partial aggregates:

* ``kpi_parts``: a day's sums and counts, and the set of its units;
* ``sensor_parts``: the same of a day's sensor;
* ``stability``: the rolling statistics of the days that the load touches, as
  slices (see ``streaming.rolling``), which replace those days' earlier ones.

Sets of units are exact and mergeable: an id is cut into a prefix and its
trailing number, and the numbers of a prefix are bits of bitmaps of 4 KB, which
are merged by OR. Ids that are numbered one after another, as units are, need
about a bit each; scattered ones a nearly empty bitmap each, which compresses.

``register_live_views`` stores the views as SQL text over the folders. It reads
no rows (a footer of each table, for its columns), and as the text is resolved
whenever a view is queried, loads that come later show at once. The rank and
the statistics of slices' first rows are windows over one row a sensor and
eight rows a day, whatever the number of units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import DIRECTION_FAIL, DIRECTION_PASS
from .views import VIEW_ORDER

ROWS = 5
#: The slice of rows without a time, before all others.
NO_TIME = -1_000_000_000
#: Time, id, and then the other columns, so that ties fall alike everywhere.
ORDER = ["Timestamp", "Wafer_ID", "Failure_Probability", "Predicted_Class", "Actual_Result"]
PREDICTIONS = "Wafer_ID {id}, Timestamp timestamp_ntz, Actual_Result int, Predicted_Class int, Failure_Probability double"
RCA = "Wafer_ID {id}, Timestamp timestamp_ntz, Sensor_Name string, SHAP_Value double, Rank int"
TIMES = "Wafer_ID {id}, Timestamp timestamp_ntz"
KPI_PARTS = "Production_Date date, units string, bits binary, n long, actual long, predicted long, p double, n_p long"
SENSOR_PARTS = "Day date, last timestamp_ntz, Sensor_Name string, units string, bits binary, total double, n_total long, most double, n long"
STABILITY = PREDICTIONS + ", _mean double, _std double, _head boolean, _tail boolean"


def unit_bits(unit: Column) -> tuple[Column, Column]:
    """The bitmap that an id belongs to (null for a null id), and its bit."""
    text = unit.cast("string")
    digits = F.regexp_extract(text, "([0-9]{0,15})$", 1)
    number = F.coalesce(F.when(digits != "", digits.cast("long")), F.lit(0).cast("long"))
    prefix = F.substring(text, F.lit(1), F.length(text) - F.length(digits))
    name = F.concat(prefix, F.lit("#"), F.length(digits).cast("string"), F.lit("#"), F.bitmap_bucket_number(number).cast("string"))
    return name, F.when(text.isNotNull(), F.bitmap_bit_position(number))


def kpi_parts(predictions: DataFrame) -> DataFrame:
    """Mergeable aggregates of each day's units."""
    units, bit = unit_bits(F.col("Wafer_ID"))
    failed = F.when(F.col("Predicted_Class") == 1, F.col("Failure_Probability"))
    rows = predictions.withColumns({"units": units, "bit": bit, "p": failed, "day": F.to_date("Timestamp")})
    return rows.groupBy(F.col("day").alias("Production_Date"), "units").agg(
        F.bitmap_construct_agg("bit").alias("bits"),
        F.count("Wafer_ID").alias("n"),
        F.sum(F.col("Actual_Result").cast("long")).alias("actual"),
        F.sum(F.col("Predicted_Class").cast("long")).alias("predicted"),
        F.sum("p").alias("p"),
        F.count("p").alias("n_p"),
    )


def sensor_parts(rca: DataFrame) -> DataFrame:
    """Mergeable aggregates of each sensor's day."""
    units, bit = unit_bits(F.col("Wafer_ID"))
    rows = rca.withColumns({"units": units, "bit": bit, "a": F.abs("SHAP_Value"), "Day": F.to_date("Timestamp")})
    return rows.groupBy("Day", "Sensor_Name", "units").agg(
        F.max("Timestamp").alias("last"),
        F.bitmap_construct_agg("bit").alias("bits"),
        F.sum("a").alias("total"),
        F.count("a").alias("n_total"),
        F.max("a").alias("most"),
        F.count(F.lit(1)).alias("n"),
    ).select("Day", "last", "Sensor_Name", "units", "bits", "total", "n_total", "most", "n")


def _fs(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def create_tables(spark: SparkSession, base: str, id_type: str = "string") -> None:
    """Empty tables under ``base``, so that views have columns before any load."""
    for name, schema in {"ml_predictions": PREDICTIONS, "root_cause_analysis": RCA, "unit_times": TIMES, "kpi_parts": KPI_PARTS, "sensor_parts": SENSOR_PARTS}.items():
        spark.createDataFrame([], schema.format(id=id_type)).write.mode("ignore").parquet(f"{base}/{name}/load=empty")
    spark.createDataFrame([], STABILITY.format(id=id_type)).write.mode("ignore").parquet(f"{base}/stability/slice={2 * NO_TIME}")


def _rows(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}").drop("load")


def _slice(time: Column) -> Column:
    return F.coalesce(F.unix_date(F.to_date(time)), F.lit(NO_TIME)).cast("long")


def append_load(spark: SparkSession, base: str, load: str, predictions: DataFrame, rca: DataFrame, unit_times: DataFrame) -> None:
    """Write a load and its aggregates; the same ``load`` again replaces it.
    Readers see its rows first, then its aggregates, each table at a time; a
    load that failed half-way is repeated under its name. Loads are written
    one after another."""
    given = {"ml_predictions": (PREDICTIONS, predictions), "root_cause_analysis": (RCA, rca), "unit_times": (TIMES, unit_times)}
    own = {name: f"{base}/{name}/load={load}" for name in given}
    fs, _ = _fs(spark, base)
    old = {n: spark.read.parquet(p) for n, p in own.items() if fs.exists(_fs(spark, p)[1])}
    touched = _touched(spark, base, old) if old else set()
    for name, (schema, df) in given.items():
        kind = _rows(spark, base, name).schema
        df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kind]).write.mode("overwrite").parquet(own[name])
    new = {n: spark.read.parquet(p) for n, p in own.items()}
    touched |= _touched(spark, base, new)
    kpi_parts(new["ml_predictions"]).write.mode("overwrite").option("compression", "zstd").parquet(f"{base}/kpi_parts/load={load}")
    sensor_parts(new["root_cause_analysis"]).write.mode("overwrite").option("compression", "zstd").parquet(f"{base}/sensor_parts/load={load}")
    _write_slices(spark, base, touched)


def _touched(spark: SparkSession, base: str, load: dict[str, DataFrame]) -> set[int]:
    """Days whose rolling statistics the load's units or times change (one
    number a day comes to the driver)."""
    days = load["unit_times"].select(_slice(F.col("Timestamp")).alias("slice"))
    units = load["ml_predictions"].select("Wafer_ID").distinct()
    more = _rows(spark, base, "unit_times").join(units, "Wafer_ID", "left_semi").select(_slice(F.col("Timestamp")).alias("slice"))
    return {r.slice for r in days.union(more).distinct().collect()}


def _write_slices(spark: SparkSession, base: str, touched: set[int]) -> None:
    """The rolling rows of the given days, from all loads' rows."""
    if not touched:
        return
    times = _rows(spark, base, "unit_times").withColumn("slice", _slice(F.col("Timestamp"))).filter(F.col("slice").isin(sorted(touched)))
    values = _rows(spark, base, "ml_predictions").drop("Timestamp")
    names = [c for c in _rows(spark, base, "stability").columns if not c.startswith("_") and c != "slice"]
    joined = times.join(values, "Wafer_ID").select(*names, "slice")
    own = Window.partitionBy("slice")
    frame = own.orderBy(*ORDER).rowsBetween(1 - ROWS, 0)
    x = F.col("Failure_Probability")
    mean = F.avg(x).over(frame)
    place = F.row_number().over(own.orderBy(*ORDER))
    rolled = joined.select(
        *names, mean.alias("_mean"), F.sqrt(F.greatest(F.avg(x * x).over(frame) - mean * mean, F.lit(0.0))).alias("_std"),
        (place < ROWS).alias("_head"), (place > F.count("*").over(own) - (ROWS - 1)).alias("_tail"), "slice",
    )
    rolled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slice").parquet(f"{base}/stability")
    left = {r.slice for r in joined.select("slice").distinct().collect()}
    for day in touched - left:  # a repeated load may have taken a day's last row away
        fs, folder = _fs(spark, f"{base}/stability/slice={day}")
        fs.delete(folder, True)


_SQL = {
    "v_yield_kpis": """
SELECT Production_Date, SUM(units) AS Total_Wafers, SUM(actual) AS Actual_Failures,
  ROUND(100D * SUM(actual) / NULLIF(CAST(SUM(n) AS DOUBLE), 0D), 2) AS Actual_Defect_Rate_Pct,
  SUM(predicted) AS Predicted_Failures,
  ROUND(100D * SUM(predicted) / NULLIF(CAST(SUM(n) AS DOUBLE), 0D), 2) AS Predicted_Defect_Rate_Pct,
  ROUND(try_divide(SUM(p), SUM(n_p)), 4) AS Avg_Failure_Probability
FROM (SELECT Production_Date, bitmap_count(bitmap_or_agg(bits)) AS units, SUM(n) AS n, SUM(actual) AS actual,
    SUM(predicted) AS predicted, SUM(p) AS p, SUM(n_p) AS n_p
  FROM {kpi_parts} GROUP BY Production_Date, units)
GROUP BY Production_Date""",
    "v_high_risk_sensors": """
SELECT Sensor_Name, Affected_Wafers, ROUND(impact / n_total, 6) AS Avg_Abs_SHAP, ROUND(most, 6) AS Max_Abs_SHAP,
  ROUND(impact, 6) AS Total_SHAP_Impact, Total_Appearances, CAST(RANK() OVER (ORDER BY impact DESC) AS INT) AS Impact_Rank
FROM (SELECT Sensor_Name, SUM(units) AS Affected_Wafers, SUM(total) AS impact, NULLIF(SUM(n_total), 0) AS n_total, MAX(most) AS most,
    SUM(n) AS Total_Appearances
  FROM (SELECT Sensor_Name, bitmap_count(bitmap_or_agg(bits)) AS units, SUM(total) AS total, SUM(n_total) AS n_total, MAX(most) AS most, SUM(n) AS n
    FROM {sensor_parts} WHERE Day >= date_sub(to_date((SELECT MAX(last) FROM {sensor_parts})), {days})
    GROUP BY Sensor_Name, units)
  GROUP BY Sensor_Name)""",
    "v_process_stability": """
SELECT * FROM (SELECT Wafer_ID, Timestamp, to_date(Timestamp) AS Production_Date, Predicted_Class, Failure_Probability, Actual_Result,
  (SELECT Sensor_Name FROM {sensor_parts} GROUP BY Sensor_Name ORDER BY SUM(total) DESC, Sensor_Name LIMIT 1) AS Monitored_Sensor,
  ROUND(_mean, 4) AS Rolling5_Avg_Fail_Prob, ROUND(_std, 6) AS Rolling5_StdDev_Fail_Prob
FROM (SELECT {order}, _mean, _std FROM {stability} WHERE NOT _head
  UNION ALL
  SELECT {order}, m, SQRT(GREATEST(q - m * m, 0D)) FROM (
    SELECT {order}, _head, AVG(Failure_Probability) OVER w AS m, AVG(Failure_Probability * Failure_Probability) OVER w AS q
    FROM {stability} WHERE _head OR _tail WINDOW w AS (ORDER BY {order} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE _head))
WHERE Monitored_Sensor IS NOT NULL""",
    "v_wafer_failure_detail": """
SELECT p.Wafer_ID, p.Timestamp, p.Actual_Result, p.Predicted_Class, p.Failure_Probability, r.Sensor_Name, r.SHAP_Value,
  r.Rank AS Sensor_Rank, CASE WHEN r.SHAP_Value > 0 THEN '{fail}' ELSE '{ok}' END AS SHAP_Direction
FROM {ml_predictions} p LEFT JOIN {root_cause_analysis} r ON p.Wafer_ID = r.Wafer_ID WHERE p.Predicted_Class = 1""",
}


def view_sql(base: str, days: int = 7) -> dict[str, str]:
    """The text of each view over the tables under ``base``."""
    at = base.replace("`", "``")
    tables = {n: f"parquet.`{at}/{n}`" for n in ("kpi_parts", "sensor_parts", "stability", "ml_predictions", "root_cause_analysis")}
    return {k: v.format(**tables, days=int(days), order=", ".join(ORDER), fail=DIRECTION_FAIL, ok=DIRECTION_PASS) for k, v in _SQL.items()}


def register_live_views(spark: SparkSession, base: str, days: int = 7, ordered: bool = True) -> list[str]:
    """The four views as temporary SQL views over the tables under ``base``,
    sorted as the batch ones unless ``ordered=False``."""
    views = view_sql(base, days)
    for name, sql in views.items():
        by = ", ".join(f"{c} {d.upper()}" for c, d in VIEW_ORDER[name])
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT * FROM ({sql})" + (f" ORDER BY {by}" if ordered else ""))
    return list(views)
