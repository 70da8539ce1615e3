"""Cleaning edge cases (hand-written frames)."""

import numpy as np
from pyspark.sql import functions as F

from yieldlab.operators import cleaning as C


def _long(spark, cols):
    """cols: {sensor_no: [values per unit]} -> long frame."""
    rows = [(u, s, v) for s, vals in cols.items() for u, v in enumerate(vals)]
    return spark.createDataFrame(rows, "unit_no long, sensor_no int, value double")


def test_missing_threshold_is_strict(spark):
    df = _long(spark, {1: [1.0, None, 2.0, None], 2: [None, None, None, 1.0], 3: [1.0, 2.0, 3.0, 4.0]})
    kept = {r.sensor_no for r in C.drop_high_missing(df).select("sensor_no").distinct().collect()}
    assert kept == {1, 3}  # exactly 0.5 stays, 0.75 goes


def test_all_missing_and_constant_columns(spark):
    df = _long(spark, {1: [None] * 4, 2: [7.0] * 4, 3: [1.0, 2.0, None, 4.0]})
    out = C.clean_sensors(df)
    assert {r.sensor_no for r in out.select("sensor_no").distinct().collect()} == {3}
    assert C.remaining_missing(out).first()[0] == 0
    imputed = {r.unit_no: r.value for r in out.collect()}
    assert imputed[2] == 2.0  # median of 1, 2, 4


def test_single_row_keeps_all(spark):
    df = _long(spark, {1: [3.0], 2: [5.0]})
    assert C.clean_sensors(df).count() == 2


def test_constant_after_imputation_is_dropped(spark):
    df = _long(spark, {1: [2.0, None, 2.0], 2: [1.0, None, 3.0]})
    kept = {r.sensor_no for r in C.clean_sensors(df).collect()}
    assert kept == {2}


def test_exact_medians_match_numpy(spark):
    rng = np.random.default_rng(3)
    cols = {s: [float(x) for x in rng.integers(0, 30, size=n)] for s, n in [(1, 7), (2, 8), (3, 1)]}
    df = _long(spark, cols)
    got = {r.sensor_no: r.median for r in C.exact_medians(df).collect()}
    for s, vals in cols.items():
        assert got[s] == float(np.median(vals))


def test_fit_on_train_apply_elsewhere(spark):
    train = _long(spark, {1: [1.0, 3.0, 5.0], 2: [4.0, 4.0, 4.0]})
    test = _long(spark, {1: [None, 10.0], 2: [1.0, 2.0]})
    model = C.SensorCleaner().fit(train)
    out = {(r.unit_no, r.sensor_no): r.value for r in model.transform(test).collect()}
    assert out == {(0, 1): 3.0, (1, 1): 10.0}


def test_wide_long_round_trip(spark):
    wide = spark.createDataFrame([(0, 1.0, None), (1, 2.0, 3.0)], "unit_no long, `Sensor-1` double, `Sensor 2` double")
    long_df = C.to_long(wide, ["unit_no"])
    assert long_df.count() == 4
    back = C.to_wide(long_df.withColumnRenamed("sensor", "sensor_no"), ["unit_no"],
                     ["Sensor-1", "Sensor 2"])
    assert back.columns == ["unit_no", "Sensor_1", "Sensor_2"]
    assert back.orderBy("unit_no").collect()[1]["Sensor_2"] == 3.0


def test_top_variance(spark):
    df = _long(spark, {1: [0.0, 10.0], 2: [0.0, 1.0], 3: [5.0, 5.0]})
    got = [r.sensor_no for r in C.top_variance_sensors(df, n=2).collect()]
    assert got == [1, 2]


def test_bracket_medians_exact_with_ties_and_misses(spark):
    import random

    rnd = random.Random(9)
    cols = {
        1: [float(rnd.randint(0, 1000)) for _ in range(401)],      # odd count
        2: [float(rnd.randint(0, 5)) for _ in range(300)],         # heavy ties
        3: [7.0] * 50 + [float(i) for i in range(51)],             # ties at the middle
        4: [float(i) for i in range(2)],                           # tiny
        5: [rnd.gauss(0, 1) for _ in range(256)],                  # even count
    }
    df = _long(spark, cols)
    for acc, margin in ((10000, None), (20, 0.0), (5, 0.3)):   # margin 0 forces misses
        got = {r.sensor_no: r.median for r in
               C.exact_medians(df, accuracy=acc, margin=margin).collect()}
        for s, vals in cols.items():
            assert got[s] == float(np.median(vals)), (acc, margin, s)


def test_separation_without_spread(spark):
    """A sensor that separates the classes perfectly, and a constant one."""
    from yieldlab.operators.screening import sensor_separation

    rows = [(i, s, v, y) for i, y in enumerate((0, 0, 1, 1)) for s, v in ((1, 1.0 + 4 * y), (2, 3.0), (3, float(i)))]
    df = spark.createDataFrame(rows, "unit_no long, sensor_no int, value double, Label int")
    got = {r.sensor_no: r for r in sensor_separation(df).collect()}
    assert (got[1].s2n, got[1].welch_t, got[1].f_stat, got[1].pearson_r) == (None, None, None, 1.0)
    assert got[2].s2n is None and got[3].s2n is not None
