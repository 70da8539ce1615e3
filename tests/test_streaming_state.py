"""KPIs in streaming state: exact, over several runs, with closed days."""

import datetime as dt

from pyspark.sql import functions as F

from yieldlab.plans import adapters as ad
from yieldlab.plans.views import yield_kpis
from yieldlab.streaming import state as S

SF = "/root/testdata/sf0.001"
SCHEMA = "Wafer_ID string, Timestamp timestamp_ntz, Actual_Result int, Predicted_Class int, Failure_Probability double"


def ordered(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def run(spark, source, out, state):
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    q = S.keep_totals(S.day_totals(stream, "1 day"), out, state)
    q.awaitTermination(180)
    return q


def files(path):
    return len(list(path.rglob("*.parquet")))


def test_every_day_equals_the_batch_view(spark):
    assert ordered(S.run_state_kpis(spark, SF)) == ordered(yield_kpis(ad.predictions(spark, SF)))


def test_two_runs_restart_and_late_rows(spark, tmp_path):
    """A second run goes on from the state of the first; units seen before
    count once; a closed day takes no more rows; files stay as many."""
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    day = lambda d, h=0: dt.datetime(2024, 3, d, h)

    def put(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    first = [(f"W{i}", day(1 + i % 3, i % 24), int(i % 4 == 0), int(i % 3 == 0), i / 100) for i in range(60)]
    first += [(None, day(2), 1, 0, 0.5), ("W1", day(2), None, None, None)]
    put(first)
    run(spark, source, out, state)
    batch = lambda rows: ordered(yield_kpis(spark.createDataFrame(rows, SCHEMA)))
    assert ordered(S.kpis_from_totals(spark, out).drop("Closed")) == batch(first)
    before = files(tmp_path / "out")

    second = [(f"W{i}", day(3, i % 24), 1, 1, 0.25) for i in range(0, 90, 2)]
    put(second)
    run(spark, source, out, state)
    assert ordered(S.kpis_from_totals(spark, out).drop("Closed")) == batch(first + second)
    assert files(tmp_path / "out") <= before + S.PARTS

    # Day 9 moves the watermark over days 1 to 3, which close; a run later their rows are late.
    third = [("X", day(9), 0, 1, 0.75)]
    put(third)
    run(spark, source, out, state)
    fourth = [("Y", day(9, 5), 0, 0, 0.1)]
    put(fourth + [("late", day(1), 1, 1, 0.9)])
    q = run(spark, source, out, state)
    got = {r.Production_Date.day: r.Closed for r in S.kpis_from_totals(spark, out).collect()}
    assert got == {1: True, 2: True, 3: True, 9: False}
    assert ordered(S.kpis_from_totals(spark, out).drop("Closed")) == batch(first + second + third + fourth)
    assert S.late_rows(q) == 1
    totals = spark.read.parquet(out)
    assert totals.groupBy("Production_Date", "part").count().filter(F.col("count") > 1).count() == 0
