"""Physical-plan properties that matter at scale."""

import contextlib
import io

from pyspark.sql import functions as F

from yieldlab.operators import attribution as A
from yieldlab.plans import adapters as ad

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_top_n_limits_before_shuffle(spark):
    top = A.top_n_per_unit(ad.lineitem_attributions(spark, SF), "Wafer_ID", "SHAP_Value", 3, ["sensor_no"])
    plan = _plan(top)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # the partial limit sits below the exchange
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_scan_prunes_columns(spark):
    plan = _plan(ad.predictions(spark, SF).select("Wafer_ID", "Predicted_Class"))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_kpi_aggregation_is_partial(spark):
    from yieldlab.plans.views import yield_kpis

    plan = _plan(yield_kpis(ad.predictions(spark, SF)))
    assert plan.count("HashAggregate") >= 2 and "SinglePartition" not in plan


def test_long_readings_are_not_shuffled_by_sensor(spark):
    """Per-sensor tables are broadcast after a count, whatever the automatic
    threshold."""
    from yieldlab.operators import cleaning as C
    from yieldlab.plans import views as V

    long_df = ad.sensor_long(spark, SF)
    coef = long_df.select("sensor_no").distinct().withColumn("coef", F.lit(0.5))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (C.drop_high_missing(long_df), C.impute_median(long_df), C.drop_zero_variance(long_df),
                   C.clean_sensors(long_df), A.linear_attribution(long_df, coef)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan
            assert not any(w in plan for w in ("SortMergeJoin", "ShuffledHashJoin", "Exchange hashpartitioning"))
        assert "BroadcastHashJoin" in V.control_limits(long_df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
