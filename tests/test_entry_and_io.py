"""Driver contract and Parquet round trip."""

import datetime as dt

import __spark_entry__ as entry  # noqa: E402
from yieldlab.plans.catalog import QUERIES
from yieldlab.sources import tables as TB


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "Production_Date"
    assert df.count() > 0


def test_oracle_keys_are_queries():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert {"yield_kpis", "high_risk_sensors", "process_stability", "failure_detail"} <= set(o)
    assert set(QUERIES) <= set(o)  # of the corpus queries some have no SQL


def test_parquet_round_trip_partitioned(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 5), "S1", 0.5, 1), (2, dt.datetime(2024, 1, 2, 6), "S2", -0.1, 1)],
        "Wafer_ID long, Timestamp timestamp_ntz, Sensor_Name string, SHAP_Value double, Rank int")
    TB.write_table(df.withColumn("id", df.Wafer_ID), str(tmp_path / "rca"))
    back = TB.drop_autoincrement(TB.read_table(spark, str(tmp_path / "rca")))
    assert sorted(back.collect()) == sorted(df.select(*back.columns).collect())
    assert dict(back.dtypes)["Timestamp"] == "timestamp_ntz"


def test_workers_need_no_install(tmp_path):
    """Run the Python-side job from a folder where workers cannot import the
    package (as on a cluster without it installed)."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(repo, "__spark_entry__.py")!r})
mod = importlib.util.module_from_spec(spec); spec.loader.exec_module(mod)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
n = mod.queries()["tree_attribution"](spark, "/root/testdata/sf0.001").count()
print("ROWS", n)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    assert int(out.stdout.split("ROWS")[1].split()[0]) > 0


def test_drop_materialized(spark):
    import os

    from yieldlab.session import _WRITTEN, drop_materialized, materialize

    drop_materialized(spark)
    t = materialize(spark.range(10), "probe")
    assert t.count() == 10
    path = _WRITTEN[-1]
    local = path[len("file:"):] if path.startswith("file:") else path
    assert os.path.isdir(local)
    assert drop_materialized(spark) == 1 and not os.path.exists(local)
