"""Query catalog: one callable ``(spark, sf_dir) -> DataFrame`` per operator
of the survey's inventory (section 2), each run over whole test tables
through the adapters of ``adapters.py``. ``oracle.py`` holds the matching
DuckDB SQL; of the model keys it checks what holds whatever the trees are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import attribution as A
from ..operators import boosting as BT
from ..operators import cleaning as C
from ..operators import metrics as M
from ..operators import quantiles as QT
from ..operators import selection as SL
from ..operators import split as S
from ..operators import timeline as TL
from ..operators.ordering import rolling_stats
from ..operators.screening import sensor_separation
from ..session import ensure_checkpoint_dir
from ..sources import delimited as DL
from ..sources import loads as LD
from ..sources import tables as TB
from ..sources import text as TX
from ..streaming.kpis import run_stream_kpis
from ..streaming.rolling import run_stream_stability
from ..streaming.state import run_state_kpis
from . import adapters as ad
from . import live
from . import quality as Q
from . import views as V
from .end_to_end import run_yield_analysis

Query = Callable[[SparkSession, str], DataFrame]

AXIS_END = "2024-01-31 00:00:00"


# ---- shared building blocks ---------------------------------------------------


def _orders_rca(s, d):
    return A.top_sensors_per_failure(
        ad.lineitem_attributions(s, d), ad.orders_predictions(s, d)
    )


def _clean(s, d):
    return C.clean_sensors(ad.sensor_long(s, d))


def _production_logs(s, d):
    long_df = ad.sensor_long(s, d)
    model = C.SensorCleaner().fit(long_df)
    return TB.production_logs(model.transform(long_df), ad.unit_meta(s, d), model.sensors())


def _split_predictions(s, d):
    return S.time_split(ad.predictions(s, d), ["Timestamp", "Wafer_ID"])


def _built_predictions(s, d):
    """Reference mode: tune the threshold on the test rows, apply it there."""
    test = _split_predictions(s, d).filter(F.col("Split") == S.TEST)
    thr = M.best_f1_threshold(test, "Failure_Probability", "Actual_Result").select("threshold")
    return M.build_predictions(
        test, thr, label_col="Actual_Result", score_col="Failure_Probability"
    )


def _quality_tables(s, d):
    meta = ad.unit_meta(s, d).select(F.col("unit_no").alias("Wafer_ID"), "Timestamp", "Label")
    return {
        "production_logs": meta,
        "ml_predictions": ad.predictions(s, d),
        "root_cause_analysis": ad.rca(s, d),
    }


def _scored_units(s, d):
    units = S.time_split(ad.unit_meta(s, d), ["Timestamp", "unit_no"])
    test = units.filter(F.col("Split") == S.TEST).select("unit_no")
    return ad.sensor_long(s, d).join(test, "unit_no", "left_semi")


def _rolling(s, d, col):
    e = ad.table(s, d, "events").select("event_id", "ts", "value")
    r = rolling_stats(e, ["ts", "event_id"], "value", 5, "rolling_mean", "rolling_std")
    return r.select("event_id", F.round(col, 6).alias(col))


def _sensor_text(s, d):
    parsed = TX.parse_sensor_lines(ad.sensor_lines(s, d))
    return TX.features_to_long(parsed, ["unit_no"])


def _label_text(s, d):
    return TX.parse_label_lines(ad.label_lines(s, d)).select("Wafer_ID", "Label", "Timestamp")


def _linear(s, d):
    clean = _clean(s, d)
    coef = clean.select("sensor_no").distinct().withColumn(
        "coef", ((F.col("sensor_no") % 5) - 2) / F.lit(10.0)
    )
    out = A.linear_attribution(clean, coef)
    return out.select("unit_no", "sensor_no", F.round("attribution", 9).alias("attribution"))


def _run(s, d):
    return run_yield_analysis(
        s, ad.sensor_long(s, d), ad.unit_meta(s, d), register=False, explain="all"
    )


def _trained(s, d):
    """Predictions of the trained model; what its probabilities must be is
    stated as flags, so that the rows can be checked."""
    run = _run(s, d)
    thr = run.metrics["threshold"]
    p = F.col("Failure_Probability")
    return run.predictions.select(
        "Wafer_ID", "Timestamp", "Actual_Result", p.between(0, 1).alias("Is_Probability"),
        F.when(F.col("Predicted_Class") == 1, p >= F.round(F.lit(thr), 6))
        .otherwise(p <= F.round(F.lit(thr), 6)).alias("Class_Agrees"),
    )


def _additivity(s, d):
    """Per test unit: base value plus all attributions, less the model's
    log-odds, which is 0."""
    run = _run(s, d)
    p = F.col("Probability")
    sums = run.attributions.groupBy("Wafer_ID").agg(F.sum("SHAP_Value").alias("s"))
    return run.scored.join(sums, "Wafer_ID", "left").select(
        "Wafer_ID",
        F.abs(F.round(F.lit(run.base_value) + F.coalesce("s", F.lit(0.0)) - F.ln(p / (1 - p)), 6)).alias("Residual"),
    )


def _separators(s, d):
    """Clean readings, and one sensor (0) that separates the classes without
    any spread."""
    lab = ad.unit_meta(s, d).select("unit_no", "Label")
    both = _clean(s, d).select("unit_no", "sensor_no", "value").unionByName(
        lab.select("unit_no", F.lit(0).alias("sensor_no"), (F.col("Label") * 4.0 + 1.0).alias("value"))
    )
    return both.join(lab, "unit_no")


def _boosted_splits(s, d):
    """Every node of the first tree of the regularised trainer: whether a line
    is dear, by quantity (missing for each seventh order), discount, tax and
    line number; dear lines weigh 3."""
    price = F.col("l_extendedprice") > 60000
    rows = ad.table(s, d, "lineitem").select(
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")).alias("quantity"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"), F.col("l_linenumber").cast("double").alias("line"),
        F.when(price, 1).otherwise(0).alias("Label"), F.when(price, 3.0).otherwise(1.0).alias("weight"),
    )
    params = BT.BoostParams(rounds=1, max_depth=2, subsample=1.0, colsample=1.0)
    nodes = BT.train_boosted(rows, ["quantity", "discount", "tax", "line"], validation_col=None, params=params).split_table(s)
    split = F.col("feature") >= 0
    return nodes.select(
        "node", "feature_name", F.when(split, F.round("threshold", 6)).alias("threshold"), F.when(split, F.col("missing_left")).alias("missing_left"),
        F.when(split, F.round("gain", 6)).alias("gain"), F.round("cover", 6).alias("cover"), F.round("grad", 6).alias("grad"),
        F.when(~split, F.round("value", 9)).alias("leaf_value"),
    )


def _live(view: str) -> Query:
    """A view over tables that three loads have filled one after another."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = f"{ensure_checkpoint_dir(spark)}/live-{uuid.uuid4().hex}"
        live.create_tables(spark, base, "long")
        given = [ad.predictions(spark, sf_dir), ad.rca(spark, sf_dir), ad.production_logs_events(spark, sf_dir)]
        part = F.coalesce(F.pmod(F.unix_date(F.to_date("Timestamp")), F.lit(3)), F.lit(0))
        for load in range(3):
            live.append_load(spark, base, str(load), *[df.filter(part == load) for df in given])
        return spark.sql(live.view_sql(base)[view])

    return run


def _quantile_table(s, d):
    """Quantiles from sketches that three loads of days have written, with
    whether each rank is within twice the stated error (five standard
    deviations)."""
    base = f"{ensure_checkpoint_dir(s)}/quantiles-{uuid.uuid4().hex}"
    readings = ad.sensor_long(s, d).join(ad.unit_meta(s, d).select("unit_no", "Timestamp"), "unit_no")
    for load in range(3):
        part = readings.filter(F.pmod(F.unix_date(F.to_date("Timestamp")), F.lit(3)) == load)
        QT.append_quantiles(part, base, str(load), "Timestamp")
    found = QT.quantiles(QT.read_quantile_parts(s, base))
    checked = QT.rank_errors(found, ad.sensor_long(s, d))
    return checked.select(
        "sensor_no", "p", "n_readings", "n_missing", "lowest", "highest",
        (F.coalesce("rank_error", F.lit(0.0)) <= 2 * QT.rank_error()).alias("within"),
    )


def _load_violations(s, d):
    """Rows and broken constraints of each table's load, and the rows that a
    reader then finds."""
    base = f"{ensure_checkpoint_dir(s)}/loads-{uuid.uuid4().hex}"
    logs, pred, rca = ad.production_logs_events(s, d), ad.orders_predictions(s, d), ad.rca(s, d)
    chance = F.col("Failure_Probability")
    checks = {
        "production_logs": (logs, LD.Checks(["Wafer_ID", "Timestamp", "Label"], key=["Wafer_ID"])),
        "ml_predictions": (pred, LD.Checks(
            ["Wafer_ID"], {"probability": chance.between(0, 1), "class": (F.col("Predicted_Class") == 1) == (chance >= 0.8)},
            ["Wafer_ID"], logs, "Wafer_ID")),
        "root_cause_analysis": (rca, LD.Checks(
            ["Wafer_ID", "Sensor_Name", "SHAP_Value", "Rank"], {"rank": F.col("Rank") <= 2}, ["Wafer_ID"], logs, "Wafer_ID")),
    }
    rows = []
    for name, (df, rules) in checks.items():
        if name == "production_logs":
            report = LD.load_days(df, f"{base}/{name}", checks=rules, on_violation="report")
            found = LD.read_days(s, f"{base}/{name}").count()
        else:
            report = LD.load_table(df, f"{base}/{name}", rules, on_violation="report")
            found = LD.read_current(s, f"{base}/{name}").count()
        rows += [(name, "n_rows", report.n_rows), (name, "n_read", found)]
        rows += [(name, check, n) for check, n in report.violations.items()]
    return s.createDataFrame(rows, "table_name string, check_name string, n long")


def _reloaded_kpis(s, d):
    """Daily KPIs of a table whose every third day was first loaded wrongly
    and then replaced by a load of those days."""
    path = f"{ensure_checkpoint_dir(s)}/reloaded-{uuid.uuid4().hex}"
    pred = ad.predictions(s, d)
    third = F.pmod(F.unix_date(F.to_date("Timestamp")), F.lit(3)) == 0
    LD.load_days(pred.withColumn("Predicted_Class", F.when(third, 1).otherwise(F.col("Predicted_Class"))), path)
    LD.load_days(pred.filter(third), path)
    return V.yield_kpis(LD.read_days(s, path).drop(TB.DATE_PART))


def _sensor_csv(s, d):
    """Comma-separated lines with quoted fields, lines of another width and
    unreadable readings, parsed to one row a sensor."""
    lines = ad.sensor_csv_lines(s, d)
    parsed = DL.parse_matrix_lines(lines, DL.find_layout(lines))
    return TX.features_to_long(
        parsed.select("unit_no", F.col("bad_line").isNotNull().alias("is_bad"), "features"), ["unit_no", "is_bad"]
    )


def _selection_errors(s, d):
    """The selection baselines over ten folds of the cleaned readings: rows
    that each method classified, and as flags, so that the rows can be
    checked, what must hold of its errors."""
    cells = F.array_sort(F.collect_list(F.struct("sensor_no", "value")))
    units = _clean(s, d).groupBy("unit_no").agg(F.transform(cells, lambda c: c["value"]).alias("features"))
    found = SL.cross_validated(units.join(ad.unit_meta(s, d).select("unit_no", "Label"), "unit_no"), top=20)
    error = F.col("balanced_error_rate")
    mean = (F.col("true_fail_rate") + F.col("true_pass_rate")) / 2
    agrees = error.between(0, 1) & (F.abs(error - (1 - mean)) < 1e-9)
    return found.groupBy("method").agg(
        F.sum("n_pass").alias("n_pass"), F.sum("n_fail").alias("n_fail"), F.bool_and(F.coalesce(agrees, F.lit(True))).alias("errors_agree"),
        F.bool_and((F.size("selected") <= 20) & (F.size(F.array_distinct("selected")) == F.size("selected"))).alias("selected_distinct"),
    )



QUERIES: dict[str, Query] = {
    # 2.10 views and 2.4 aggregations
    "yield_kpis": lambda s, d: V.yield_kpis(ad.predictions(s, d)),
    "yield_kpis_orders": lambda s, d: V.yield_kpis(ad.orders_predictions(s, d)),
    "high_risk_sensors": lambda s, d: V.high_risk_sensors(ad.rca(s, d)),
    "high_risk_sensors_orders": lambda s, d: V.high_risk_sensors(_orders_rca(s, d)),
    "process_stability": lambda s, d: V.process_stability(
        ad.production_logs_events(s, d), ad.predictions(s, d), ad.rca(s, d)
    ),
    "process_stability_orders": lambda s, d: V.process_stability(
        ad.orders_production_logs(s, d), ad.orders_predictions(s, d), _orders_rca(s, d)
    ),
    "failure_detail": lambda s, d: V.failure_detail(ad.predictions(s, d), ad.rca(s, d)),
    "failure_detail_orders": lambda s, d: V.failure_detail(
        ad.orders_predictions(s, d), _orders_rca(s, d)
    ),
    "control_limits": lambda s, d: V.control_limits(_clean(s, d)),
    "top_sensor": lambda s, d: V.top_sensor(ad.rca(s, d)),
    "recurring_sensors": lambda s, d: A.recurring_sensors(ad.rca(s, d)),
    "label_summary": lambda s, d: S.label_summary(ad.predictions(s, d), "Actual_Result"),
    "class_weight": lambda s, d: S.class_weight(
        _split_predictions(s, d).filter(F.col("Split") != S.TEST), "Actual_Result"
    ),
    # 2.8 attribution
    "top_sensors_per_failure": lambda s, d: A.top_sensors_per_failure(
        ad.attributions(s, d), ad.predictions(s, d)
    ),
    "top_sensors_per_failure_orders": _orders_rca,
    "linear_attribution": _linear,
    "global_importance": lambda s, d: A.global_importance(ad.attributions(s, d)),
    "unit_waterfall": lambda s, d: A.unit_waterfall(ad.attributions(s, d)),
    # 2.2 cleaning
    "sensor_missing_fraction": lambda s, d: C.missing_fraction(ad.sensor_long(s, d)),
    "drop_high_missing": lambda s, d: C.drop_high_missing(ad.sensor_long(s, d)),
    "impute_median": lambda s, d: C.impute_median(ad.sensor_long(s, d)),
    "drop_zero_variance": lambda s, d: C.drop_zero_variance(ad.sensor_long(s, d)),
    "sensor_quantiles": _quantile_table,
    "clean_sensors": _clean,
    "clean_sensors_lineitem": lambda s, d: C.clean_sensors(ad.lineitem_sensor_long(s, d)),
    "remaining_missing": lambda s, d: C.remaining_missing(_clean(s, d)),
    "top_variance_sensors": lambda s, d: C.top_variance_sensors(_clean(s, d), 20),
    "assign_unit_id": lambda s, d: TL.assign_unit_id(
        ad.unit_meta(s, d).select("unit_no"), ["unit_no"]
    ),
    "fill_timestamps": lambda s, d: TL.fill_timestamps(ad.gapped_times(s, d), ["Wafer_ID"]),
    "even_time_axis": lambda s, d: TL.even_time_axis(
        ad.unit_meta(s, d).select("unit_no"), ["unit_no"], AXIS_END
    ),
    "select_scored_units": _scored_units,
    # 2.1 sources and sinks, 2.3 joins
    "load_sensor_text": _sensor_text,
    "load_sensor_csv": _sensor_csv,
    "parse_label_lines": _label_text,
    "production_logs": _production_logs,
    "attach_labels": lambda s, d: ad.sensor_long(s, d).join(
        ad.unit_meta(s, d), "unit_no", "inner"
    ),
    # 2.5 windows
    "rolling_mean": lambda s, d: _rolling(s, d, "rolling_mean"),
    "rolling_std": lambda s, d: _rolling(s, d, "rolling_std"),
    # 2.7 modelling and evaluation
    "time_split": lambda s, d: _split_predictions(s, d).select("Wafer_ID", "Split_Index", "Split"),
    "pr_curve": lambda s, d: M.pr_curve(
        ad.predictions(s, d), "Failure_Probability", "Actual_Result"
    ),
    "best_f1_threshold": lambda s, d: M.best_f1_threshold(
        ad.predictions(s, d), "Failure_Probability", "Actual_Result"
    ),
    "roc_auc": lambda s, d: M.roc_auc(ad.predictions(s, d), "Failure_Probability", "Actual_Result"),
    "build_predictions": _built_predictions,
    "confusion_matrix": lambda s, d: M.confusion_matrix(_built_predictions(s, d)),
    "classification_report": lambda s, d: M.classification_report(_built_predictions(s, d)),
    "balanced_error_rate": lambda s, d: M.balanced_error_rate(_built_predictions(s, d)),
    "sensor_separation": lambda s, d: sensor_separation(_separators(s, d)),
    "selection_errors": _selection_errors,
    "train_score_gbt": _trained,
    "tree_attribution": _additivity,
    "boosted_tree_splits": _boosted_splits,
    # 2.12 streaming form of the daily KPIs
    "stream_yield_kpis": run_stream_kpis,
    "state_yield_kpis": run_state_kpis,
    "stream_process_stability": lambda s, d: run_stream_stability(
        s, d, ad.production_logs_events(s, d), ad.rca(s, d)
    ),
    # 2.10 views that follow their tables
    "live_yield_kpis": _live("v_yield_kpis"),
    "live_high_risk_sensors": _live("v_high_risk_sensors"),
    "live_process_stability": _live("v_process_stability"),
    # 2.11 data quality
    "table_row_counts": lambda s, d: Q.table_row_counts(_quality_tables(s, d)),
    "load_violations": _load_violations,
    "reloaded_yield_kpis": _reloaded_kpis,
    "key_violations": lambda s, d: Q.key_violations(_quality_tables(s, d)),
    "orphan_rows": lambda s, d: Q.orphan_rows(_quality_tables(s, d)),
}
