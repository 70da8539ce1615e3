"""Loads take effect whole or not at all; constraints are counted in the write."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from yieldlab.sources import loads as L

SCHEMA = "Wafer_ID string, Timestamp timestamp_ntz, P double"


def day(d, n, p=0.5, first=0):
    at = dt.datetime(2024, 3, d) if d else None
    return [(f"W{d}_{i}", at, p) for i in range(first, first + n)]


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("Wafer_ID", "Timestamp", "P").collect()), key=repr)


def failing(df):
    """Its last rows raise while they are written, after others have been."""
    return df.withColumn("P", F.when(F.col("Wafer_ID").endswith("_7"), F.raise_error(F.lit("killed")).cast("double")).otherwise(F.col("P")))


def test_days_are_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    first = day(1, 20) + day(2, 20) + day(0, 3)
    L.load_days(make(spark, first), path)
    untouched = {f: os.stat(f"{path}/Production_Date=2024-03-01/{f}").st_mtime_ns for f in os.listdir(f"{path}/Production_Date=2024-03-01")}
    report = L.load_days(make(spark, day(2, 5, 0.9) + day(3, 4) + day(0, 1, 0.1)), path)
    assert report.n_rows == 10 and report.clean
    want = day(1, 20) + day(2, 5, 0.9) + day(3, 4) + day(0, 1, 0.1)
    assert rows_of(L.read_days(spark, path)) == sorted(want, key=repr)
    assert untouched == {f: os.stat(f"{path}/Production_Date=2024-03-01/{f}").st_mtime_ns for f in os.listdir(f"{path}/Production_Date=2024-03-01")}


def test_a_load_killed_while_writing_leaves_the_old_days(spark, tmp_path):
    path = str(tmp_path / "t")
    L.load_days(make(spark, day(1, 9) + day(2, 9)), path)
    with pytest.raises(Exception, match="killed"):
        L.load_days(failing(make(spark, day(1, 40, 0.9))), path)
    assert rows_of(L.read_days(spark, path)) == sorted(day(1, 9) + day(2, 9), key=repr)
    L.load_days(make(spark, day(2, 1)), path)  # takes what the killed one left away
    assert rows_of(L.read_days(spark, path)) == sorted(day(1, 9) + day(2, 1), key=repr)
    assert not os.listdir(f"{path}/{L.STAGED}")


def test_a_load_killed_while_moving_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    L.load_days(make(spark, day(1, 9) + day(2, 9)), path)
    real, calls = L._delete, []

    def dies(spark, folder):
        if calls:
            raise KeyboardInterrupt
        calls.append(folder)
        real(spark, folder)

    monkeypatch.setattr(L, "_delete", dies)
    with pytest.raises(KeyboardInterrupt):  # after the first of two days
        L.load_days(make(spark, day(1, 2, 0.9) + day(2, 2, 0.9)), path)
    monkeypatch.setattr(L, "_delete", real)
    assert rows_of(L.read_days(spark, path)) == sorted(day(1, 2, 0.9) + day(2, 9), key=repr)
    L.finish_loads(spark, path)
    L.finish_loads(spark, path)
    assert rows_of(L.read_days(spark, path)) == sorted(day(1, 2, 0.9) + day(2, 2, 0.9), key=repr)


def test_tables_swap_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        L.read_current(spark, path)
    L.load_table(make(spark, day(1, 9)), path)
    held = L.read_current(spark, path)
    with pytest.raises(Exception, match="killed"):
        L.load_table(failing(make(spark, day(2, 40))), path)
    assert rows_of(L.read_current(spark, path)) == sorted(day(1, 9), key=repr)
    # made from the version that it replaces
    L.load_table(L.read_current(spark, path).withColumn("P", F.col("P") * 2), path)
    assert rows_of(L.read_current(spark, path)) == sorted(day(1, 9, 1.0), key=repr)
    assert rows_of(held) == sorted(day(1, 9), key=repr)  # a reader of the old version goes on
    assert len(L.versions(spark, path)) == 2
    assert L.drop_versions(spark, path, 1) == 2  # the old one and the failed one
    assert rows_of(L.read_current(spark, path)) == sorted(day(1, 9, 1.0), key=repr)


def test_violations_are_counted_or_fail(spark, tmp_path):
    rows = day(1, 5) + [("W1_0", dt.datetime(2024, 3, 1), 1.5), (None, None, None), (None, dt.datetime(2024, 3, 1), -1.0), ("x", None, 0.1)]
    parent = spark.createDataFrame([(f"W1_{i}",) for i in range(4)] + [(None,)], "Wafer_ID string")
    checks = L.Checks(["Wafer_ID", "Timestamp"], {"p": F.col("P").between(0, 1)}, ["Wafer_ID"], parent, "Wafer_ID")
    want = {"null_Wafer_ID": 2, "null_Timestamp": 2, "broken_p": 2, "duplicate_key": 1, "orphan": 2}
    for load, read in ((L.load_table, L.read_current), (L.load_days, L.read_days)):
        path = str(tmp_path / load.__name__)
        load(make(spark, day(1, 2)), path, checks=checks)
        with pytest.raises(L.LoadRejected) as e:
            load(make(spark, rows), path, checks=checks)
        assert e.value.report.violations == want and e.value.report.n_rows == 9
        assert rows_of(read(spark, path)) == sorted(day(1, 2), key=repr)
        report = load(make(spark, rows), path, checks=checks, on_violation="report")
        assert report.violations == want and not report.clean
        assert read(spark, path).count() == 9
        with pytest.raises(ValueError):
            load(make(spark, rows), path, checks=checks, on_violation="ignore")


def test_row_constraints_cost_no_scan(spark, tmp_path):
    """One more count of rows would read the source again."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = make(spark, day(1, 30) + day(2, 30)).mapInPandas(count, SCHEMA)
    report = L.load_table(df, str(tmp_path / "t"), L.Checks(["P"], {"p": F.col("P") > 0}, ["Wafer_ID"]))
    assert report.n_rows == 60 and seen.value == 60


def test_empty_loads(spark, tmp_path):
    empty = make(spark, day(1, 1)).limit(0)
    checks = L.Checks(["P"], {}, ["Wafer_ID"])
    path = str(tmp_path / "t")
    assert L.load_table(empty, path, checks).n_rows == 0
    assert L.read_current(spark, path).count() == 0
    days = str(tmp_path / "d")
    L.load_days(make(spark, day(1, 3)), days)
    assert L.load_days(empty, days, checks=checks) and L.read_days(spark, days).count() == 3  # no day, nothing replaced
