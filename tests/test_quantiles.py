"""Quantile tables of merged sketches against numpy."""

import datetime as dt
import os
import random

import numpy as np
import pytest

from yieldlab.operators import cleaning as C
from yieldlab.operators import quantiles as Q

SCHEMA = "sensor_no int, unit_no long, value double, at timestamp_ntz"


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def readings(rng, day, n, sensors=4):
    at = dt.datetime(2024, 5, 1 + day, 12)
    draw = [lambda: rng.gauss(0, 1), lambda: float(rng.randrange(3)), lambda: rng.expovariate(1), lambda: rng.choice([None, 2.0, float("nan")])]
    return [(s, day * n + i, draw[s % 4](), at) for s in range(sensors) for i in range(n)]


def share(values, q, p):
    below, up_to = np.mean(values < q), np.mean(values <= q)
    return max(below - p, p - up_to, 0.0)


def test_merged_loads_keep_the_stated_rank(spark, tmp_path):
    rng, base = random.Random(4), str(tmp_path / "q")
    days = [readings(rng, d, 3000) for d in range(4)]
    for i, rows in enumerate(days):
        Q.append_quantiles(make(spark, rows), base, str(i), "at")
    parts = Q.read_quantile_parts(spark, base)
    assert parts.count() == 16  # a row a sensor and day
    got = Q.quantiles(parts).collect()
    assert len(got) == 4 * len(Q.PROBABILITIES)
    for r in got:
        all_values = [v for rows in days for s, _, v, _ in rows if s == r.sensor_no]
        values = np.array([v for v in all_values if v is not None and v == v])
        assert (r.n_readings, r.n_missing) == (len(values), len(all_values) - len(values))
        assert (r.lowest, r.highest) == (values.min(), values.max())
        assert r.quantile in set(values.tolist())
        assert share(values, r.quantile, r.p) <= 2 * Q.rank_error()
    measured = Q.rank_errors(Q.quantiles(parts), make(spark, sum(days, []))).collect()
    assert max(r.rank_error for r in measured) <= 2 * Q.rank_error()


def test_a_load_reads_no_other_and_replaces_itself(spark, tmp_path):
    rng, base = random.Random(5), str(tmp_path / "q")
    first, second = readings(rng, 0, 50), readings(rng, 1, 50)
    Q.append_quantiles(make(spark, first), base, "a", "at")
    before = {f: os.stat(os.path.join(base, "load=a", f)).st_mtime_ns for f in os.listdir(f"{base}/load=a")}
    Q.append_quantiles(make(spark, second), base, "b", "at")
    Q.append_quantiles(make(spark, second), base, "b", "at")
    after = {f: os.stat(os.path.join(base, "load=a", f)).st_mtime_ns for f in os.listdir(f"{base}/load=a")}
    assert before == after
    n = {r.sensor_no: r.n_readings + r.n_missing for r in Q.merge_parts(Q.read_quantile_parts(spark, base)).collect()}
    assert n == {s: 100 for s in range(4)}
    one = Q.read_quantile_parts(spark, base).filter("Day = DATE'2024-05-02'")
    assert {r.n_readings + r.n_missing for r in Q.merge_parts(one).collect()} == {50}


def test_small_sets_are_exact_and_missing_is_null(spark):
    at = dt.datetime(2024, 5, 1)
    rows = [(1, i, float(i), at) for i in range(101)] + [(2, 0, None, at), (2, 1, float("nan"), None), (None, 0, 7.0, None)]
    got = {(r.sensor_no, r.p): r for r in Q.quantiles(Q.quantile_parts(make(spark, rows), "at"), [0.0, 0.5, 1.0]).collect()}
    assert [got[1, p].quantile for p in (0.0, 0.5, 1.0)] == [0.0, 50.0, 100.0]
    assert got[2, 0.5].quantile is None and got[2, 0.5].n_missing == 2 and got[2, 0.5].lowest is None
    assert got[None, 0.5].quantile == 7.0


def test_empty_table(spark):
    parts = Q.quantile_parts(make(spark, [(1, 1, 1.0, None)]).limit(0), "at")
    assert Q.quantiles(parts).count() == 0


def test_probabilities_are_checked(spark):
    parts = Q.quantile_parts(make(spark, [(1, 1, 1.0, None)]), "at")
    for wrong in ([], [1.5]):
        with pytest.raises(ValueError):
            Q.quantiles(parts, wrong)


def test_sketched_medians_impute(spark):
    rng = random.Random(6)
    rows = [r[:3] for r in readings(rng, 0, 2000)] + [(0, 9000, None)]
    long_df = spark.createDataFrame(rows, "sensor_no int, unit_no long, value double")
    parts = Q.quantile_parts(long_df.selectExpr("*", "timestamp_ntz'2024-05-01 00:00:00' AS at"), "at")
    out = C.impute_median(long_df, Q.sketched_medians(parts))
    filled = out.filter("unit_no = 9000").first().value
    values = np.array([v for s, _, v in rows if s == 0 and v is not None])
    assert share(values, filled, 0.5) <= 2 * Q.rank_error()
    assert out.count() == len(rows)
