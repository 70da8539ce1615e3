"""Views and root-cause operators on hand-written frames."""

import datetime as dt

from yieldlab.operators import attribution as A
from yieldlab.plans import views as V

D = dt.datetime


def _pred(spark, rows):
    return spark.createDataFrame(
        rows, "Wafer_ID long, Timestamp timestamp_ntz, Actual_Result int, "
              "Predicted_Class int, Failure_Probability double")


def _rca(spark, rows):
    return spark.createDataFrame(
        rows, "Wafer_ID long, Timestamp timestamp_ntz, Sensor_Name string, SHAP_Value double, Rank int")


def test_yield_kpis_day_without_predicted_fail(spark):
    p = _pred(spark, [(1, D(2024, 1, 1, 1), 1, 0, 0.2), (2, D(2024, 1, 1, 2), 0, 0, 0.1),
                      (3, D(2024, 1, 2, 1), 0, 1, 0.8), (3, D(2024, 1, 2, 2), 1, 1, 0.6)])
    assert V.yield_kpis(p).columns == V.YIELD_KPI_COLUMNS
    got = {r.Production_Date: r for r in V.yield_kpis(p).collect()}
    d1, d2 = got[dt.date(2024, 1, 1)], got[dt.date(2024, 1, 2)]
    assert d1.Avg_Failure_Probability is None and d1.Actual_Defect_Rate_Pct == 50.0
    assert d2.Total_Wafers == 1  # distinct ids; rates use the row count
    assert d2.Predicted_Defect_Rate_Pct == 100.0 and d2.Avg_Failure_Probability == 0.7


def test_high_risk_window_edges(spark):
    r = _rca(spark, [(1, D(2024, 1, 10, 23), "S1", 0.5, 1),
                     (2, D(2024, 1, 3, 0, 1), "S2", -0.4, 1),   # 7 days before by date: kept
                     (3, D(2024, 1, 2, 23), "S3", 0.9, 1),      # 8 days before: dropped
                     (4, D(2024, 1, 9), "S1", 0.1, 2)])
    got = {x.Sensor_Name: x for x in V.high_risk_sensors(r).collect()}
    assert set(got) == {"S1", "S2"}
    assert got["S1"].Impact_Rank == 1 and got["S1"].Total_SHAP_Impact == 0.6
    assert got["S2"].Impact_Rank == 2 and got["S1"].Affected_Wafers == 2


def test_failure_detail_left_join_direction(spark):
    p = _pred(spark, [(1, D(2024, 1, 1), 1, 1, 0.9), (2, D(2024, 1, 1), 0, 1, 0.7),
                      (3, D(2024, 1, 1), 0, 0, 0.1)])
    r = _rca(spark, [(1, D(2024, 1, 1), "S1", 0.0, 1), (1, D(2024, 1, 1), "S2", 0.3, 2)])
    got = sorted((x.Wafer_ID, x.Sensor_Name, x.SHAP_Direction) for x in V.failure_detail(p, r).collect())
    assert got == [(1, "S1", "Pushes Toward Pass"), (1, "S2", "Pushes Toward Fail"),
                   (2, None, "Pushes Toward Pass")]


def test_process_stability_empty_rca_gives_no_rows(spark):
    p = _pred(spark, [(1, D(2024, 1, 1), 1, 1, 0.9)])
    logs = spark.createDataFrame([(1, D(2024, 1, 1), 1)], "Wafer_ID long, Timestamp timestamp_ntz, Label int")
    assert V.process_stability(logs, p, _rca(spark, [])).count() == 0


def test_process_stability_duplicate_times(spark):
    p = _pred(spark, [(i, D(2024, 1, 1), 0, 0, float(i)) for i in range(6)])
    logs = p.selectExpr("Wafer_ID", "Timestamp", "Actual_Result AS Label")
    r = _rca(spark, [(1, D(2024, 1, 1), "S9", 1.0, 1)])
    got = {x.Wafer_ID: x.Rolling5_Avg_Fail_Prob for x in V.process_stability(logs, p, r).collect()}
    assert got == {0: 0.0, 1: 0.5, 2: 1.0, 3: 1.5, 4: 2.0, 5: 3.0}


def test_top_n_ties_opposite_sign(spark):
    long_df = spark.createDataFrame(
        [(1, 1, "S1", -0.5), (1, 2, "S2", 0.5), (1, 3, "S3", 0.2), (1, 4, "S4", 0.0)],
        "Wafer_ID long, sensor_no int, Sensor_Name string, SHAP_Value double")
    got = [(r.Sensor_Name, r.Rank) for r in
           A.top_n_per_unit(long_df, "Wafer_ID", "SHAP_Value", 2, ["sensor_no"]).orderBy("Rank").collect()]
    assert got == [("S1", 1), ("S2", 2)]


def test_top_sensors_no_predicted_fail_has_schema(spark):
    attr = spark.createDataFrame([(1, 1, "S1", 0.5)], "Wafer_ID long, sensor_no int, Sensor_Name string, SHAP_Value double")
    p = _pred(spark, [(1, D(2024, 1, 1), 0, 0, 0.1)])
    out = A.top_sensors_per_failure(attr, p)
    assert out.count() == 0
    assert out.columns == ["Wafer_ID", "Timestamp", "Sensor_Name", "SHAP_Value", "Rank"]


def test_unit_waterfall_folds_rest(spark):
    rows = [(1, i, f"S{i}", float(i) * (-1) ** i) for i in range(1, 21)]
    attr = spark.createDataFrame(rows, "Wafer_ID long, sensor_no int, Sensor_Name string, SHAP_Value double")
    out = A.unit_waterfall(attr, base_value=1.5).orderBy("Position").collect()
    assert len(out) == 15 and out[-1].Feature == "6 other features"
    assert abs(out[0].Cumulative - (1.5 + sum(r[3] for r in rows))) < 1e-9
    assert out[0].Feature == "S20"


def test_process_stability_monitored_value(spark):
    p = _pred(spark, [(i, D(2024, 1, 1, i), 0, 0, 0.1 * i) for i in range(3)])
    logs = p.selectExpr("Wafer_ID", "Timestamp", "Actual_Result AS Label")
    r = _rca(spark, [(1, D(2024, 1, 1), "S9", 1.0, 1)])
    readings = spark.createDataFrame([(0, "S9", 4.0), (1, "S9", 5.0), (1, "S1", 9.0)],
                                     "Wafer_ID long, Sensor_Name string, value double")
    got = {x.Wafer_ID: x.Monitored_Value
           for x in V.process_stability(logs, p, r, readings=readings).collect()}
    assert got == {0: 4.0, 1: 5.0, 2: None}


def test_hot_unit_top_n_and_waterfall(spark):
    """One unit holds a third of all rows; results equal a pandas reference."""
    import random

    import pandas as pd

    rnd = random.Random(2)
    rows = [(1, s, f"S{s}", round(rnd.uniform(-1, 1), 6)) for s in range(3000)]
    rows += [(u, s, f"S{s}", round(rnd.uniform(-1, 1), 6)) for u in range(2, 2002) for s in range(3)]
    schema = "Wafer_ID long, sensor_no int, Sensor_Name string, SHAP_Value double"
    attr = spark.createDataFrame(rows, schema).repartition(8)
    top = A.top_n_per_unit(attr, "Wafer_ID", "SHAP_Value", 3, ["sensor_no"])
    got = sorted((r.Wafer_ID, r.Rank, r.sensor_no) for r in top.collect())
    pdf = pd.DataFrame(rows, columns=["Wafer_ID", "sensor_no", "Sensor_Name", "SHAP_Value"])
    pdf["a"] = pdf.SHAP_Value.abs()
    pdf = pdf.sort_values(["Wafer_ID", "a", "sensor_no", "SHAP_Value"], ascending=[True, False, True, True])
    pdf["Rank"] = pdf.groupby("Wafer_ID").cumcount() + 1
    exp = sorted((int(w), int(k), int(s)) for w, k, s in
                 pdf[pdf.Rank <= 3][["Wafer_ID", "Rank", "sensor_no"]].itertuples(index=False))
    assert got == exp
    wf = {r.Position: r for r in A.unit_waterfall(attr).filter("Wafer_ID = 1").collect()}
    assert wf[15].Feature == "2986 other features"
    assert abs(wf[1].Cumulative - round(pdf[pdf.Wafer_ID == 1].SHAP_Value.sum(), 9)) < 1e-8
