"""The full yield analysis as one lazy Spark program.

Phases (the reference's five scripts): load sensors and labels -> clean ->
time split -> class-weighted boosted trees -> threshold for best F1 ->
predictions -> tree attributions -> top sensors per predicted failure ->
production log -> views. Only the model, the threshold and small per-sensor
parameter tables reach the driver.

Decisions (see SURVEY section 0.1): the threshold is tuned on the validation
rows by default (``tune_on="test"`` reproduces the reference); the cleaner
is fitted on all rows like the reference (``fit_cleaner_on="train"`` avoids
the leak); row order is (Timestamp, file position).
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import unit_id_from_index
from ..operators import boosting as BT
from ..operators import cleaning as C
from ..operators import metrics as M
from ..operators import model as MD
from ..operators import split as S
from ..operators import treeshap as TS
from ..operators.attribution import (
    global_importance,
    recurring_sensors,
    top_sensors_per_failure,
    unit_waterfall,
)
from ..session import materialize
from ..sources import tables as TB
from ..sources import text as TX
from . import views as V
from .quality import table_row_counts


@dataclass
class YieldRun:
    predictions: DataFrame
    rca: DataFrame
    attributions: DataFrame
    production_logs: DataFrame
    bundle: MD.ModelBundle | BT.BoostedModel
    base_value: float
    metrics: dict = field(default_factory=dict)
    views: list = field(default_factory=list)
    scored: DataFrame | None = None  # Wafer_ID, Probability of every test unit
    evaluation: dict = field(default_factory=dict)  # small tables of the test units, by name
    cleaner: C.CleanerModel | None = None

    def save(self, path: str) -> None:
        """Model, threshold and cleaner, all that ``score_units`` needs."""
        MD.save_bundle(self.bundle, path)
        C.save_cleaner(self.cleaner, f"{path}/cleaner")

    def explain_unit(self, unit_id: str, max_display: int = 15) -> DataFrame:
        """The waterfall of one explained unit from the model's base value,
        with its readings (NULL in the row of the other features)."""
        own = self.attributions.filter(F.col("Wafer_ID") == unit_id)
        falls = unit_waterfall(own, self.base_value, max_display, tie_cols=("feature_index",))
        logs = self.production_logs.filter(F.col("Wafer_ID") == unit_id)
        sensors = [c for c in logs.columns if c not in ("Wafer_ID", "Timestamp", "Label")]
        readings = logs.select(*[F.col(c).cast("double") for c in sensors]).unpivot([], sensors, "Feature", "Reading")
        return falls.join(readings, "Feature", "left")


def units_from_labels(labels: DataFrame, fallback_end: str | None = None) -> DataFrame:
    """``row_idx, Label, Timestamp`` (from ``load_label_text``) -> units with
    filled times; the unit number is the file position.

    Single unreadable times are filled forward, then backward. When no time
    is readable at all, the units get an evenly spaced 30-day axis ending at
    ``fallback_end`` (default: now, cut to the minute), as the reference does.
    """
    from ..operators.timeline import even_time_axis, fill_timestamps

    if labels.filter(F.col("Timestamp").isNotNull()).limit(1).count() == 0:
        if fallback_end is None:
            fallback_end = datetime.now().replace(second=0, microsecond=0).isoformat(" ")
        timed = even_time_axis(labels.drop("Timestamp"), ["row_idx"], fallback_end)
    else:
        timed = fill_timestamps(labels, ["row_idx"])
    return timed.select(F.col("row_idx").alias("unit_no"), "Timestamp", "Label")


def explain_rows(spark: SparkSession, bundle: MD.ModelBundle | BT.BoostedModel, rows: DataFrame) -> tuple[DataFrame, float]:
    """Attributions of ``rows`` (wide, scored or not), written once, and the
    model's base value."""
    names = bundle.feature_names
    if isinstance(bundle, BT.BoostedModel):
        tables = TS.build_leaf_tables(bundle.node_tables(), len(names), scale=1.0)
        tables.base += bundle.base_margin
    else:
        tables = TS.build_leaf_tables(TS.read_trees(spark, bundle.gbt), len(names))
    arrays = rows.withColumn("features_arr", F.array(*[F.col(n).cast("double") for n in names]))
    return materialize(TS.tree_attributions(arrays, tables, names, id_cols=("Wafer_ID",)), "attributions"), tables.base


def stored(spark: SparkSession, df: DataFrame, name: str, out_dir: str | None) -> DataFrame:
    """``df`` written once and read back: under ``out_dir``, by production
    date, or else in the checkpoint folder."""
    if not out_dir:
        return materialize(df, name)
    TB.write_table(df, f"{out_dir}/{name}")
    return TB.read_table(spark, f"{out_dir}/{name}")


def score_units(
    spark: SparkSession,
    bundle_path: str,
    sensor_long: DataFrame,
    units: DataFrame,
    top_n: int = 3,
    out_dir: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Predictions and root causes of new units with a saved run's model,
    threshold and cleaner (``YieldRun.save``); nothing is fitted.

    ``sensor_long`` and ``units`` as in ``run_yield_analysis``; without a
    ``Label`` column ``Actual_Result`` is NULL. Readings of sensors that the
    cleaner dropped are left out, missing ones take its medians. Units without
    any reading of a kept sensor don't appear."""
    bundle = MD.load_bundle(spark, bundle_path)
    cleaner = C.load_cleaner(spark, f"{bundle_path}/cleaner")
    sensors = cleaner.sensors()
    wide = C.to_wide(cleaner.transform(sensor_long), ["unit_no"], sensors, names=[f"Sensor_{s}" for s in sensors])
    if "Label" not in units.columns:
        units = units.withColumn("Label", F.lit(None).cast("int"))
    data = wide.join(units.select("unit_no", "Timestamp", "Label"), "unit_no").withColumn(
        "Wafer_ID", unit_id_from_index(F.col("unit_no"))
    )
    scored = materialize(MD.score(bundle, data), "scored")
    predictions = M.build_predictions(scored, bundle.threshold, score_col="probability_fail")
    predictions = stored(spark, predictions, "ml_predictions", out_dir)
    attributions, _ = explain_rows(spark, bundle, scored.filter(F.col("probability_fail") >= bundle.threshold))
    rca = top_sensors_per_failure(attributions, predictions, top_n, tie_cols=("feature_index",))
    return predictions, stored(spark, rca, "root_cause_analysis", out_dir)


def run_yield_analysis(
    spark: SparkSession,
    sensor_long: DataFrame,
    units: DataFrame,
    top_n: int = 3,
    tune_on: str = S.VALIDATION,
    fit_cleaner_on: str = "all",
    gbt_params: MD.GBTParams | BT.BoostParams | None = None,
    register: bool = True,
    days: int = 7,
    out_dir: str | None = None,
    explain: str = "failures",
    top_sensors: int | None = None,
) -> YieldRun:
    """``sensor_long``: ``unit_no, sensor_no, value``; ``units``:
    ``unit_no, Timestamp, Label`` (unit_no = 0-based file position).

    ``metrics["phase_seconds"]`` holds the wall clock spent in each phase by
    the jobs the phase itself needs; each phase writes what it makes.
    ``explain``: attributions of the predicted ``"failures"`` only, which the
    root causes need, or of ``"all"`` test units. ``gbt_params``: the
    regularised trainer's (the default) or, as ``GBTParams``, Spark ML's.
    ``top_sensors``: only so many sensors, those of the largest variance, go
    to the production log (None: all). With ``out_dir`` the cleaned features
    and the labels are written too."""
    clock = [time.perf_counter()]
    phases: dict[str, float] = {}

    def lap(name: str) -> None:
        clock.append(time.perf_counter())
        phases[name] = round(clock[-1] - clock[-2], 3)

    split = S.time_split(units, ["Timestamp", "unit_no"]).select(
        "unit_no", "Timestamp", "Label", "Split"
    )
    fit_rows = sensor_long
    if fit_cleaner_on == "train":
        fit_rows = sensor_long.join(
            split.filter(F.col("Split") != S.TEST).select("unit_no"), "unit_no", "left_semi"
        )
    cleaner = C.SensorCleaner().fit(fit_rows)
    sensors = cleaner.sensors()
    names = [f"Sensor_{s}" for s in sensors]
    clean_long = cleaner.transform(sensor_long)
    wide = C.to_wide(clean_long, ["unit_no"], sensors, names=names)
    data = (
        wide.join(split, "unit_no", "inner")
        .withColumn("Wafer_ID", unit_id_from_index(F.col("unit_no")))
        .persist()
    )

    train = data.filter(F.col("Split") != S.TEST)
    cw = S.class_weight(train, "Label").first()
    lap("preprocessing")
    train = MD.with_class_weight(train, "Label", cw["scale_pos_weight"]).withColumn(
        "is_validation", F.col("Split") == S.VALIDATION
    )
    if isinstance(gbt_params, MD.GBTParams):
        bundle = MD.train_gbt(train, names, params=gbt_params)
    else:
        bundle = BT.train_boosted(train, names, params=gbt_params)
    lap("training")

    scored = MD.score(bundle, data.filter(F.col("Split") != S.TRAIN)).persist()
    tune_rows = scored.filter(F.col("Split") == tune_on)
    best = M.best_f1_threshold(tune_rows, "probability_fail", "Label").first()
    threshold = float(best["threshold"]) if best is not None else 0.5
    bundle.threshold = threshold
    test = scored.filter(F.col("Split") == S.TEST)
    predictions = M.build_predictions(
        test, threshold, label_col="Label", score_col="probability_fail"
    )
    lap("threshold")

    explained = test if explain == "all" else test.filter(F.col("probability_fail") >= threshold)
    attributions, base_value = explain_rows(spark, bundle, explained)
    rca = top_sensors_per_failure(
        attributions, predictions, top_n, tie_cols=("feature_index",)
    )
    logged = names
    if top_sensors is not None:
        widest = {f"Sensor_{r[0]}" for r in C.top_variance_sensors(clean_long, top_sensors).collect()}
        logged = [n for n in names if n in widest]
    plogs = data.select("Wafer_ID", "Timestamp", "Label", *logged)
    lap("attribution")

    # Write the three output tables once (to ``out_dir``, partitioned by
    # production date, or to the checkpoint folder) and build everything
    # downstream on the written tables: attribution and scoring run once.
    outputs = {"production_logs": plogs, "ml_predictions": predictions,
               "root_cause_analysis": rca}
    loaded = {name: stored(spark, df, name, out_dir) for name, df in outputs.items()}
    if out_dir:
        TB.write_table(data.select("Wafer_ID", *names), f"{out_dir}/cleaned_features")
        TB.write_table(data.select("Wafer_ID", "Timestamp", "Label"), f"{out_dir}/labels")
    plogs, predictions, rca = (
        loaded["production_logs"], loaded["ml_predictions"], loaded["root_cause_analysis"]
    )
    every = materialize(test.select("Wafer_ID", F.col("probability_fail").alias("Probability")), "scored")
    lap("table_load")

    evaluation = {
        "confusion_matrix": M.confusion_matrix(predictions),
        "classification_report": M.classification_report(predictions),
        "roc_auc": M.roc_auc(
            every.join(predictions.select("Wafer_ID", "Actual_Result"), "Wafer_ID"), "Probability", "Actual_Result"
        ),
        "global_importance": global_importance(attributions),
        "recurring_sensors": recurring_sensors(rca),
        "table_row_counts": table_row_counts(loaded),
    }
    run = YieldRun(predictions, rca, attributions, plogs, bundle, base_value, {
        "threshold": threshold,
        "scale_pos_weight": float(cw["scale_pos_weight"]),
        "n_trees": bundle.meta.get("n_trees"),
        "n_features": len(names),
        "phase_seconds": phases,
    }, scored=every, evaluation=evaluation, cleaner=cleaner)
    data.unpersist()
    scored.unpersist()
    if register:
        if out_dir:
            run.views = V.refresh_views(spark, out_dir, days)
        else:
            run.views = V.register_views(spark, predictions, rca, plogs, days)
        lap("views")
    return run


def run_from_text(
    spark: SparkSession, sensor_path: str, label_path: str, **kwargs
) -> YieldRun:
    """Entry point for the reference's raw inputs (sensor matrix text and
    label lines)."""
    sensors = TX.load_sensor_text(spark, sensor_path).withColumnRenamed("row_idx", "unit_no")
    units = units_from_labels(TX.load_label_text(spark, label_path))
    return run_yield_analysis(spark, sensors, units, **kwargs)
