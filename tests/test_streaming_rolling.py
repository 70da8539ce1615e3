"""Rolling statistics over a stream: equal to the batch view, whatever the
order of arrival, over several runs."""

import datetime as dt
import random

from pyspark.sql import functions as F

from yieldlab.operators.ordering import rolling_stats
from yieldlab.plans import adapters as ad
from yieldlab.plans.catalog import QUERIES
from yieldlab.streaming import rolling as R

SF = "/root/testdata/sf0.001"
SCHEMA = "unit long, at timestamp_ntz, x double, extra int"
HOUR = 3600


def ordered(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def run(spark, source, out, state, lateness="2 days"):
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    q = R.keep_slices(stream, out, state, "at", "unit", "x", ["extra"], width=HOUR, lateness=lateness)
    q.awaitTermination(180)
    return q


def batch(spark, rows):
    df = spark.createDataFrame([r for r in rows if r[1] is not None], SCHEMA)
    return ordered(rolling_stats(df, ["at", "unit", "x", "extra"], "x", mean_col="_mean", std_col="_std").drop("_idx"))


def test_stream_equals_the_batch_view(spark):
    got = QUERIES["stream_process_stability"](spark, SF)
    want = QUERIES["process_stability"](spark, SF)
    assert got.columns == want.columns and dict(got.dtypes) == dict(want.dtypes)
    assert ordered(got) == ordered(want)


def test_no_attributions_no_rows(spark, tmp_path):
    p, logs = ad.predictions(spark, SF), ad.production_logs_events(spark, SF)
    p.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(p.schema).parquet(str(tmp_path / "in"))
    R.keep_stability(stream, logs, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(180)
    rca = spark.createDataFrame([], "Wafer_ID long, Timestamp timestamp_ntz, Sensor_Name string, SHAP_Value double, Rank int")
    assert R.stability_from_slices(spark, str(tmp_path / "out"), rca).count() == 0


def test_any_order_of_arrival_restart_and_late_rows(spark, tmp_path):
    """Slices of no, one, few and many rows; nulls, ties and repeated rows;
    a second run that fills slices of the first; a slice that has closed."""
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    rng = random.Random(3)
    start = dt.datetime(2024, 5, 1)

    def put(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def some(n, hours):
        at = lambda: start + dt.timedelta(hours=rng.choice(hours), minutes=rng.randrange(60))
        return [(rng.randrange(2**53, 2**53 + 99), at(), rng.choice([None, rng.random(), 0.25]), rng.choice([None, 1, 2])) for _ in range(n)]

    first = some(90, [0, 0, 0, 1, 5, 6, 20]) + [(None, start, 0.5, 1), (7, None, 0.5, 1), (8, start, None, None)]
    first += [first[0], first[0], (2**53 + 1, start + dt.timedelta(hours=9), 0.125, None)]
    put(first)
    run(spark, source, out, state)
    assert ordered(R.rolling_rows(spark, out)) == batch(spark, first)

    # earlier than most rows that are there, between them, and in a slice that is new
    second = some(40, [0, 2, 5, 9, 10]) + some(3, [3])
    put(second)
    run(spark, source, out, state)
    assert ordered(R.rolling_rows(spark, out)) == batch(spark, first + second)
    assert R.closed_slices(spark, out).count() == 0

    third = [(1, start + dt.timedelta(days=5), 0.75, None)]
    put(third)
    run(spark, source, out, state)
    put([(2, start, 0.5, None), (3, start + dt.timedelta(days=5, minutes=-90), 0.375, 2)])
    q = run(spark, source, out, state)
    every = first + second + third + [(3, start + dt.timedelta(days=5, minutes=-90), 0.375, 2)]
    assert ordered(R.rolling_rows(spark, out)) == batch(spark, every)
    hours = {int(r[1].replace(tzinfo=dt.timezone.utc).timestamp()) // HOUR for r in first + second if r[1]}
    assert {r.slice for r in R.closed_slices(spark, out).collect()} == hours
    assert sum(int(s["numRowsDroppedByWatermark"]) for p in q.recentProgress for s in p["stateOperators"]) == 1
    files = spark.read.parquet(out).filter("not closed").select("slice", F.input_file_name().alias("f")).distinct()
    assert files.groupBy("slice").count().filter("count > 1").isEmpty()
