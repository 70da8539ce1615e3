"""The whole analysis from raw text files (sensor matrix + label lines)."""

import random

from pyspark.sql import functions as F

from yieldlab.operators import model as MD
from yieldlab.plans import quality as Q
from yieldlab.plans import views as V
from yieldlab.plans.end_to_end import run_from_text, units_from_labels
from yieldlab.sources import text as TX
from yieldlab.sources.tables import read_table


def _write_inputs(tmp_path, n=120, width=9, seed=3):
    rnd = random.Random(seed)
    sens, labs = [], []
    for i in range(n):
        fail = rnd.random() < 0.25
        vals = []
        for j in range(width):
            if j == 0:
                vals.append("5")  # constant sensor
            elif j == 1 and rnd.random() < 0.7:
                vals.append("NaN")  # mostly missing sensor
            elif rnd.random() < 0.05:
                vals.append("NaN")
            else:
                shift = 2.0 if (fail and j in (2, 3)) else 0.0
                vals.append(f"{rnd.gauss(shift, 1):.4f}")
        sens.append(" ".join(vals))
        day = 1 + i // 8
        labs.append(f'{1 if fail else -1} "{day:02d}/05/2010 {i % 8 + 8:02d}:{i % 60:02d}:00"')
    labs[5] = '-1 "garbled"'
    (tmp_path / "sensor_matrix.data").write_text("\n".join(sens) + "\n")
    (tmp_path / "unit_labels.data").write_text("\r\n".join(labs) + "\r\n")
    return str(tmp_path / "sensor_matrix.data"), str(tmp_path / "unit_labels.data")


def test_run_from_text(spark, tmp_path):
    sp, lp = _write_inputs(tmp_path)
    run = run_from_text(spark, sp, lp, gbt_params=MD.GBTParams(max_iter=20, max_depth=3))
    assert run.metrics["n_features"] == 7  # constant and sparse sensors dropped
    preds = run.predictions
    assert preds.columns == ["Wafer_ID", "Timestamp", "Actual_Result", "Predicted_Class",
                             "Failure_Probability"]
    assert preds.count() == 24  # last 20% of 120 units
    n_fail = preds.filter("Predicted_Class = 1").count()
    per_unit = run.rca.groupBy("Wafer_ID").count().collect()
    assert len(per_unit) == n_fail and all(r["count"] <= 3 for r in per_unit)
    assert run.production_logs.count() == 120
    assert run.production_logs.filter(F.col("Wafer_ID") == "WAFER_0001").count() == 1
    smoke = {r.view_name: r for r in Q.smoke_test(spark, run.views).collect()}
    assert smoke["v_process_stability"].n_columns == 9
    assert smoke["v_yield_kpis"].preview_rows > 0
    assert spark.sql("SELECT COUNT(*) FROM v_wafer_failure_detail").first()[0] >= n_fail
    days = [r.Production_Date for r in spark.table("v_yield_kpis").collect()]
    assert days == sorted(days)
    ranks = [r.Impact_Rank for r in spark.table("v_high_risk_sensors").collect()]
    assert ranks == sorted(ranks)
    assert set(run.evaluation) == {"confusion_matrix", "classification_report", "roc_auc", "global_importance",
                                   "recurring_sensors", "table_row_counts"}
    assert all(df.count() > 0 or n_fail == 0 for df in run.evaluation.values())
    assert run.attributions.select("Wafer_ID").distinct().count() <= n_fail
    assert run.scored.count() == 24
    unit = run.attributions.first()
    if unit is not None:
        rows = {r.Position: r for r in run.explain_unit(unit.Wafer_ID, max_display=4).collect()}
        total = run.attributions.filter(F.col("Wafer_ID") == unit.Wafer_ID).agg(F.sum("SHAP_Value")).first()[0]
        assert abs(rows[1].Cumulative - run.base_value - total) < 1e-9
        log = run.production_logs.filter(F.col("Wafer_ID") == unit.Wafer_ID).first().asDict()
        assert rows[1].Reading == log[rows[1].Feature]
        assert 4 not in rows or rows[4].Reading is None


def test_all_times_unreadable_gets_even_axis(spark, tmp_path):
    p = tmp_path / "labels.data"
    p.write_text("\n".join(["-1 bad", "1 bad", "-1 bad", "-1 bad", "1 bad"]) + "\n")
    units = units_from_labels(TX.load_label_text(spark, str(p)), fallback_end="2024-01-31 00:00:00")
    times = [r.Timestamp for r in units.orderBy("unit_no").collect()]
    assert str(times[0]) == "2024-01-01 00:00:00" and str(times[-1]) == "2024-01-31 00:00:00"
    assert len(set(times)) == 5


def test_command_line(spark, tmp_path):
    from yieldlab.__main__ import main
    from yieldlab.operators.model import load_bundle

    sp, lp = _write_inputs(tmp_path, n=60)
    out = str(tmp_path / "out")
    metrics = main([sp, lp, out, "--tune-on", "test", "--max-iter", "10"])
    assert metrics["n_features"] == 7 and len(metrics["views"]) == 4
    assert spark.read.parquet(f"{out}/ml_predictions").count() == 12
    assert load_bundle(spark, f"{out}/model").feature_names[0] == "Sensor_3"
    assert len(spark.read.parquet(f"{out}/cleaned_features").columns) == 8
    assert spark.read.parquet(f"{out}/labels").count() == 60

    # The saved model gives the run's own test units the same predictions and causes.
    again = str(tmp_path / "again")
    counts = main([sp, lp, again, "--score-with", f"{out}/model"])["table_row_counts"]
    assert counts[0] == {"table_name": "ml_predictions", "n_rows": 60}
    for name in ("ml_predictions", "root_cause_analysis"):
        old, new = spark.read.parquet(f"{out}/{name}"), spark.read.parquet(f"{again}/{name}")
        assert old.count() and old.exceptAll(new).count() == 0

    # Appended rows show after a refresh; only recent days of the causes are read.
    before = spark.table("v_yield_kpis").agg(F.sum("Total_Wafers")).first()[0]
    late = spark.read.parquet(f"{out}/ml_predictions").limit(1).withColumn("Wafer_ID", F.lit("WAFER_9999"))
    late.write.mode("append").partitionBy("Production_Date").parquet(f"{out}/ml_predictions")
    V.refresh_views(spark, out)
    assert spark.table("v_yield_kpis").agg(F.sum("Total_Wafers")).first()[0] == before + 1
    dated = read_table(spark, f"{out}/root_cause_analysis", keep_date=True)
    plan = V.recent_window(dated)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Production_Date" in plan


def test_top_sensors_in_production_log(spark, tmp_path):
    sp, lp = _write_inputs(tmp_path, n=60)
    run = run_from_text(spark, sp, lp, gbt_params=MD.GBTParams(max_iter=5), top_sensors=2, register=False)
    assert len(run.production_logs.columns) == 5 and len(run.bundle.feature_names) == 7
