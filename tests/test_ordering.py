"""Globally ordered helpers equal the naive single-partition windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from yieldlab.operators.ordering import (
    IDX,
    fill_forward_backward,
    global_index,
    global_rank,
    rolling_stats,
    running_totals,
)


def _frame(spark, n=503, seed=7, null_every=None):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = None if null_every and rnd.random() < null_every else float(rnd.randint(0, 50))
        rows.append((i, rnd.randint(0, 20), v))
    return spark.createDataFrame(rows, "id long, k int, v double").repartition(5)


def test_global_index_dense_and_ordered(spark):
    df = _frame(spark)
    got, n = global_index(df, ["k", "id"], num_partitions=7)
    assert n == 503
    naive = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "id")) - 1)
    a = {r.id: r[IDX] for r in got.select("id", IDX).collect()}
    b = {r.id: r.rn for r in naive.select("id", "rn").collect()}
    assert a == b


def test_global_index_empty(spark):
    df = spark.createDataFrame([], "id long")
    got, n = global_index(df, ["id"])
    assert n == 0 and got.count() == 0


def test_rolling_stats_matches_window(spark):
    df = _frame(spark, n=301)
    got = rolling_stats(df, ["k", "id"], "v", rows=5, mean_col="m", std_col="s")
    w = Window.orderBy("k", "id").rowsBetween(-4, 0)
    naive = df.select(
        "id",
        F.avg("v").over(w).alias("m"),
        F.sqrt(F.greatest(F.avg(F.col("v") * F.col("v")).over(w)
                          - F.avg("v").over(w) * F.avg("v").over(w), F.lit(0.0))).alias("s"),
    )
    a = {r.id: (r.m, r.s) for r in got.select("id", "m", "s").collect()}
    b = {r.id: (r.m, r.s) for r in naive.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert abs(a[k][0] - b[k][0]) < 1e-12 and abs(a[k][1] - b[k][1]) < 1e-9


def test_rolling_stats_tiny_input(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0)], "id long, v double")
    got = sorted(rolling_stats(df, ["id"], "v").select("id", "rolling_mean").collect())
    assert [r.rolling_mean for r in got] == [2.0, 3.0]


def test_running_totals_matches_window(spark):
    df = _frame(spark).fillna(0.0)
    got = running_totals(df.withColumn("one", F.lit(1)), [F.col("k").desc(), "id"], ["one"])
    naive = df.withColumn(
        "c", F.count(F.lit(1)).over(
            Window.orderBy(F.col("k").desc(), "id").rowsBetween(Window.unboundedPreceding, 0))
    )
    a = {r.id: r.one_cum for r in got.collect()}
    b = {r.id: r.c for r in naive.collect()}
    assert a == b


def test_fill_forward_backward(spark):
    rows = [(i, None if i in (0, 1, 2, 5, 6, 9) else float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, t double")
    got = {r.id: r.t for r in fill_forward_backward(df, ["id"], "t").collect()}
    assert got == {0: 3.0, 1: 3.0, 2: 3.0, 3: 3.0, 4: 4.0, 5: 4.0, 6: 4.0,
                   7: 7.0, 8: 8.0, 9: 8.0}


def test_fill_all_null_stays_null(spark):
    df = spark.createDataFrame([(i, None) for i in range(4)], "id long, t double")
    assert all(r.t is None for r in fill_forward_backward(df, ["id"], "t").collect())


def test_global_rank_with_ties(spark):
    vals = [5.0, 3.0, 5.0, 1.0, 3.0, 9.0, None]
    df = spark.createDataFrame(list(enumerate(vals)), "id long, x double")
    got = {r.id: r.rank for r in global_rank(df, "x").collect()}
    naive = df.withColumn("r", F.rank().over(Window.orderBy(F.col("x").desc_nulls_last())))
    assert got == {r.id: r.r for r in naive.collect()}


def test_buckets_come_out_even(spark):
    """Rows of each task of the bucket window: the fullest has less than 1.5
    times the mean."""
    from yieldlab.operators import ordering as O

    n, parts = 40_000, 8
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        size = O.bucket_size(spark, n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    b = spark.range(n).withColumn("b", F.floor(F.col("id") / size)).repartition(parts, "b")
    rows = [r["count"] for r in b.groupBy(F.spark_partition_id()).count().collect()]
    assert len(rows) == parts and max(rows) < 1.5 * n / parts


def test_written_days_are_few_files(spark, tmp_path):
    from yieldlab.sources import tables as TB

    df = spark.range(2000).repartition(16).selectExpr(
        "id AS Wafer_ID", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 5 AS int)) AS Timestamp")
    TB.write_table(df, str(tmp_path / "t"))
    files = list((tmp_path / "t").glob("Production_Date=*/*.parquet"))
    assert len({f.parent for f in files}) == 5 and len(files) <= 10
    assert TB.read_table(spark, str(tmp_path / "t")).count() == 2000
