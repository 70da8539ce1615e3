"""Views over tables that loads are appended to: equal to the batch views
after every load, without registering again."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from yieldlab.operators.ordering import rolling_stats
from yieldlab.plans import live
from yieldlab.plans import views as V
from yieldlab.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
PRED, RCA, TIMES = (x.format(id="string") for x in (live.PREDICTIONS, live.RCA, live.TIMES))


def ordered(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("name", ["yield_kpis", "high_risk_sensors", "process_stability"])
def test_three_loads_equal_the_batch_view(spark, name):
    got, want = QUERIES[f"live_{name}"](spark, SF), QUERIES[name](spark, SF)
    assert dict(got.dtypes) == dict(want.dtypes)
    assert ordered(got) == ordered(want)


def make(rng, ids, day):
    """Predictions, attributions and times of units; nulls here and there."""
    at = lambda: dt.datetime(2024, 6, 1) + dt.timedelta(days=day, minutes=rng.randrange(1440))
    p = [(i, at(), rng.choice([0, 1, None]), rng.choice([0, 1, 1, None]), rng.choice([None, rng.random()])) for i in ids]
    r = [(i, at(), f"S{rng.randrange(6)}", rng.choice([None, rng.uniform(-1, 1)]), k) for i in ids[::2] for k in (1, 2)]
    return p, r, [(i, rng.choice([t, at()])) for i, t, *_ in p if i is not None]


def frames(spark, loads):
    parts = [sum((load[k] for load in loads), []) for k in range(3)]
    return [spark.createDataFrame(x, s) for x, s in zip(parts, (PRED, RCA, TIMES))]


def check(spark, loads):
    p, r, t = frames(spark, loads)
    assert ordered(spark.table("v_yield_kpis")) == ordered(V.yield_kpis(p))
    assert ordered(spark.table("v_high_risk_sensors")) == ordered(V.high_risk_sensors(r))
    assert ordered(spark.table("v_wafer_failure_detail")) == ordered(V.failure_detail(p, r))
    # the batch statistics in the views' total order: a unit with two predictions has two rows of one time
    joined = t.join(p.drop("Timestamp"), "Wafer_ID")
    rolled = rolling_stats(joined, live.ORDER, "Failure_Probability", mean_col="m", std_col="s")
    top = V.top_sensor(r).first().Sensor_Name
    want = rolled.select(
        "Wafer_ID", "Timestamp", F.to_date("Timestamp").alias("Production_Date"), "Predicted_Class", "Failure_Probability", "Actual_Result",
        F.lit(top).alias("Monitored_Sensor"), F.round("m", 4).alias("Rolling5_Avg_Fail_Prob"), F.round("s", 6).alias("Rolling5_StdDev_Fail_Prob"),
    )
    assert ordered(spark.table("v_process_stability")) == ordered(want)


def test_appended_loads_show(spark, tmp_path):
    base, rng = str(tmp_path / "live"), random.Random(8)
    live.create_tables(spark, base)
    live.register_live_views(spark, base)
    assert all(spark.table(v).count() == 0 for v in live.view_sql(base))

    first = make(rng, [f"WAFER_{i:04d}" for i in range(1, 60)] + [None, "odd", "7", "07", "WAFER_12345678901234567890"], 0)
    first[0].append(("notime", None, 1, 1, 0.5))
    first[2].append(("notime", None))
    first[1].append((None, dt.datetime(2024, 6, 1), "S1", 0.5, 1))
    live.append_load(spark, base, "a", *frames(spark, [first]))
    check(spark, [first])

    # another day, rows of the first day, units seen before, and a unit whose time comes with another load
    second = make(rng, [f"WAFER_{i:04d}" for i in range(50, 90)], 1)
    more = make(rng, ["odd", "x1", "x2", "x3"], 0)
    second = tuple(a + b for a, b in zip(second, more))
    early = make(rng, ["later"], 0)
    live.append_load(spark, base, "b", *frames(spark, [second, (early[0], [], [])]))
    third = ([], [], early[2])
    live.append_load(spark, base, "c", *frames(spark, [third]))
    loads = [first, second, (early[0], [], []), third]
    check(spark, loads)

    # the same load again changes nothing; other rows under its name replace its rows
    live.append_load(spark, base, "b", *frames(spark, [second, (early[0], [], [])]))
    check(spark, loads)
    other = make(rng, ["y1", "y2"], 20)
    live.append_load(spark, base, "b", *frames(spark, [other]))
    check(spark, [first, other, third])


def test_registering_reads_no_rows(spark, tmp_path):
    """Jobs of one task each, for the columns of the tables."""
    base, sc = str(tmp_path / "live"), spark.sparkContext
    live.create_tables(spark, base)
    live.append_load(spark, base, "a", *frames(spark, [make(random.Random(1), [f"W{i}" for i in range(500)], 3)]))
    sc.setJobGroup("register", "views")
    live.register_live_views(spark, base)
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("register") for s in tracker.getJobInfo(j).stageIds]
    assert all(s.numTasks == 1 for s in stages) and len(stages) < 25


def test_sets_of_units_are_exact(spark):
    rng = random.Random(2)
    ids = [None, "", "0", "00", "1", "01", "a", "a0", "a1", "b1", "12a", "WAFER_0001", "WAFER_1", "32768", "32769", "-1", "1 ", "9" * 30, "8" + "9" * 29]
    ids += [f"U{rng.randrange(70_000):05d}" for _ in range(4000)]
    df = spark.createDataFrame([(i,) for i in ids * 2], "Wafer_ID string").repartition(4)
    units, bit = live.unit_bits(F.col("Wafer_ID"))
    parts = df.groupBy(units.alias("units")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    n = parts.unionAll(parts).groupBy("units").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")).agg(F.sum("n")).first()[0]
    assert n == len(set(ids) - {None})
