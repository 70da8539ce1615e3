"""Globally ordered operators without a single-task window.

Several reference semantics are defined over the whole table in one order
(file position, time, score): the time split, rolling 5-row statistics,
forward/backward fill, cumulative counts of the precision-recall sweep and a
global RANK. A bare ``Window.orderBy`` would move every row into one task, so
all of them are built on one primitive:

``global_index``
    range-partition on the (total) order, sort inside partitions, record the
    range partition and the position inside it as columns, and write the
    result once as a table in the shared checkpoint folder (this fixes the
    numbering even if executors are lost later). Rows per partition (one
    small row each) give the offsets; the index is
    ``offset[partition] + position``. One shuffle, one write, no join, no
    Python.

The scans then cut the dense index into contiguous buckets of ``B`` rows and
use ordinary windows partitioned by bucket; what crosses a bucket edge is
carried by a table with one row per bucket (its size is bounded by the
configured shuffle parallelism, so broadcasting it is safe).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions

IDX = "_idx"
BUCKET = "_bucket"
_PART = "_range_part"
_POS = "_range_pos"
BUCKETS_PER_TASK = 32


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def global_index(
    df: DataFrame,
    order: Sequence[str | Column],
    idx_col: str = IDX,
    num_partitions: int | None = None,
) -> tuple[DataFrame, int]:
    """Add a dense 0-based row position in ``order``; return ``(df, n_rows)``.

    ``order`` must be a total order (add a unique tie-break column), otherwise
    rows with equal keys get an arbitrary but fixed relative order.
    """
    spark = df.sparkSession
    n_parts = num_partitions or shuffle_partitions(spark)
    keys = _cols(order)
    pid = F.spark_partition_id()
    ranged = (
        df.repartitionByRange(n_parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PART, pid)
        .withColumn(_POS, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
    )
    staged = materialize(ranged, "index")
    counts = dict((r[0], r[1]) for r in staged.groupBy(_PART).count().collect())
    offsets, running = [], 0
    for p in range(max(counts, default=0) + 1):
        offsets.append(running)
        running += counts.get(p, 0)
    # One row per range partition, so the broadcast is bounded.
    table = spark.createDataFrame(list(enumerate(offsets)), f"{_PART} int, _off long")
    joined = staged.join(F.broadcast(table), _PART)
    return (
        joined.withColumn(idx_col, F.col("_off") + F.col(_POS)).drop(_PART, _POS, "_off"),
        running,
    )


def bucket_size(spark, n_rows: int, min_size: int = 1) -> int:
    """Rows per bucket so that there are about ``BUCKETS_PER_TASK`` times
    ``shuffle.partitions`` buckets: hashed to that many tasks, they come out
    nearly even."""
    return max(min_size, math.ceil(max(n_rows, 1) / (BUCKETS_PER_TASK * shuffle_partitions(spark))))


def rolling_stats(
    df: DataFrame,
    order: Sequence[str | Column],
    value_col: str,
    rows: int = 5,
    mean_col: str = "rolling_mean",
    std_col: str | None = "rolling_std",
) -> DataFrame:
    """Mean and population std of ``value_col`` over the current row and the
    ``rows - 1`` rows before it in global ``order``.

    The std is ``sqrt(max(E[x^2] - E[x]^2, 0))`` (the reference's form).
    Buckets get a halo: the last ``rows - 1`` rows of bucket ``b`` are copied
    into bucket ``b + 1`` so that every frame is complete inside one bucket.
    """
    k = rows - 1
    indexed, n = global_index(df, order)
    size = bucket_size(df.sparkSession, n, min_size=max(k, 1))
    b = F.floor(F.col(IDX) / F.lit(size)).cast("long")
    # One scan: every row goes to its bucket; the last k rows of a bucket are
    # also copied (as halo) into the next one.
    copies = F.when(F.col(IDX) % F.lit(size) >= F.lit(size - k), F.array(b, b + 1)).otherwise(
        F.array(b)
    )
    framed = indexed.withColumn(BUCKET, F.explode(copies)).withColumn(
        "_halo", F.col(BUCKET) != b
    )
    w = Window.partitionBy(BUCKET).orderBy(IDX).rowsBetween(-k, 0)
    x = F.col(value_col)
    out = framed.withColumn(mean_col, F.avg(x).over(w))
    if std_col:
        out = out.withColumn(
            std_col,
            F.sqrt(
                F.greatest(
                    F.avg(x * x).over(w) - F.avg(x).over(w) * F.avg(x).over(w),
                    F.lit(0.0),
                )
            ),
        )
    return out.filter(~F.col("_halo")).drop("_halo", BUCKET)


def running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    sum_cols: Sequence[str],
    suffix: str = "_cum",
) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in global ``order``.

    Sums inside a bucket come from a bucket window; the sum of all earlier
    buckets comes from a one-row-per-bucket table (broadcast).
    """
    indexed, n = global_index(df, order)
    size = bucket_size(df.sparkSession, n)
    with_b = indexed.withColumn(BUCKET, F.floor(F.col(IDX) / F.lit(size)).cast("long"))
    totals = with_b.groupBy(BUCKET).agg(*[F.sum(c).alias(f"{c}__t") for c in sum_cols])
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        BUCKET, *[F.sum(f"{c}__t").over(before).alias(f"{c}__o") for c in sum_cols]
    )
    upto = Window.partitionBy(BUCKET).orderBy(IDX).rowsBetween(Window.unboundedPreceding, 0)
    local = with_b.select("*", *[F.sum(c).over(upto).alias(f"{c}__l") for c in sum_cols])
    joined = local.join(F.broadcast(offsets), BUCKET, "left")
    for c in sum_cols:
        joined = joined.withColumn(
            f"{c}{suffix}",
            F.coalesce(F.col(f"{c}__o"), F.lit(0)) + F.col(f"{c}__l"),
        )
    drop = [f"{c}__o" for c in sum_cols] + [f"{c}__l" for c in sum_cols] + [BUCKET]
    return joined.drop(*drop)


def fill_forward_backward(
    df: DataFrame,
    order: Sequence[str | Column],
    col: str,
    out_col: str | None = None,
) -> DataFrame:
    """Forward fill then backward fill of ``col`` in global ``order``.

    A NULL takes the last non-NULL value before it; leading NULLs take the
    first non-NULL value of the table. All-NULL input stays NULL.
    """
    out_col = out_col or col
    spark = df.sparkSession
    indexed, n = global_index(df, order)
    size = bucket_size(spark, n)
    n_buckets = max(1, math.ceil(n / size))
    with_b = indexed.withColumn(BUCKET, F.floor(F.col(IDX) / F.lit(size)).cast("long"))
    per_bucket = (
        with_b.filter(F.col(col).isNotNull())
        .groupBy(BUCKET)
        .agg(
            F.max_by(col, IDX).alias("_last"),
            F.min_by(col, IDX).alias("_first"),
        )
    )
    all_b = spark.range(n_buckets).withColumnRenamed("id", BUCKET)
    ordered = Window.orderBy(BUCKET)
    carry = all_b.join(per_bucket, BUCKET, "left").select(
        BUCKET,
        F.last("_last", ignorenulls=True)
        .over(ordered.rowsBetween(Window.unboundedPreceding, -1))
        .alias("_carry"),
        F.first("_first", ignorenulls=True)
        .over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("_head"),
    )
    upto = Window.partitionBy(BUCKET).orderBy(IDX).rowsBetween(Window.unboundedPreceding, 0)
    local = with_b.withColumn("_ffill", F.last(col, ignorenulls=True).over(upto))
    return (
        local.join(F.broadcast(carry), BUCKET, "left")
        .withColumn(out_col, F.coalesce("_ffill", "_carry", "_head"))
        .drop("_ffill", "_carry", "_head", BUCKET)
    )


def global_rank(
    df: DataFrame,
    value_col: str,
    rank_col: str = "rank",
    descending: bool = True,
) -> DataFrame:
    """SQL ``RANK() OVER (ORDER BY value_col [DESC])`` without one task.

    rank(v) = 1 + number of rows ordered strictly before v, from running
    counts over the distinct values. NULLs sort last for DESC, first for ASC
    (Spark's defaults).
    """
    # Materialise once: the counts and the join back both read the input.
    df = materialize(df, "rank")
    v = F.col(value_col)
    key = v.desc_nulls_last() if descending else v.asc_nulls_first()
    counts = df.groupBy(value_col).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(counts, [key], ["_n"]).select(
        F.col(value_col).alias("_v"), (F.col("_n_cum") - F.col("_n") + 1).alias(rank_col)
    )
    return (
        df.join(ranked, v.eqNullSafe(F.col("_v")), "left")
        .drop("_v")
    )
