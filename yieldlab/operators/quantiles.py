"""Mergeable quantile tables: a KLL sketch per sensor and day, written once a
load and merged when quantiles are read.

The exact medians of ``cleaning.exact_medians`` stay the default; these tables
are for readings that keep coming, as new days are added without reading the
old ones again. A sketch of size ``k`` takes a few KB (15 KB at the default)
whatever the number of readings, so a table has sensors x days small rows.

The rank of an estimate is off by at most ``rank_error(k)`` of the readings in
99 of 100 cases (0.35 % at the default), merged or not; counts, missing
readings, the lowest and the highest reading are exact.

NULL and NaN readings are missing. A sensor without readings has NULL
quantiles. A reading without a time belongs to the day NULL. A key may be
NULL; it is one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .cleaning import SENSOR, VALUE

K = 800
PROBABILITIES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def rank_error(k: int = K) -> float:
    """The published error of a rank with 99 % confidence."""
    return 2.296 / k**0.9723


def quantile_parts(
    readings: DataFrame, day: Column | str, keys: Sequence[str] = (SENSOR,), value_col: str = VALUE, k: int = K
) -> DataFrame:
    """A row for each key and day: ``sketch``, ``n_readings``, ``n_missing``,
    ``lowest``, ``highest``. Partial aggregation makes a sketch per task, so
    a sensor with most of the readings isn't gathered."""
    x = F.col(value_col).cast("double")
    rows = readings.select(*keys, F.to_date(day).alias("Day"), F.when(~F.isnan(x), x).alias("_x"))
    return rows.groupBy(*keys, "Day").agg(
        F.kll_sketch_agg_double("_x", F.lit(k)).alias("sketch"),
        F.count("_x").alias("n_readings"),
        F.count_if(F.col("_x").isNull()).alias("n_missing"),
        F.min("_x").alias("lowest"),
        F.max("_x").alias("highest"),
    )


def append_quantiles(
    readings: DataFrame, base: str, load: str, day: Column | str, keys: Sequence[str] = (SENSOR,), value_col: str = VALUE, k: int = K
) -> None:
    """Write a load's sketches to a folder of its own under ``base``, which a
    repeated load of that name replaces. Nothing else is read."""
    quantile_parts(readings, day, keys, value_col, k).write.mode("overwrite").parquet(f"{base}/load={load}")


def read_quantile_parts(spark: SparkSession, base: str) -> DataFrame:
    """The sketches of all loads; filter ``Day`` for a window of time."""
    return spark.read.parquet(base).drop("load")


def merge_parts(parts: DataFrame, keys: Sequence[str] = (SENSOR,), k: int = K) -> DataFrame:
    """One sketch a key; the result is again mergeable."""
    return parts.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
        F.sum("n_readings").alias("n_readings"),
        F.sum("n_missing").alias("n_missing"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
    )


def quantiles(
    parts: DataFrame, probabilities: Sequence[float] = PROBABILITIES, keys: Sequence[str] = (SENSOR,), k: int = K
) -> DataFrame:
    """A row for each key and probability: ``p``, ``quantile`` (a reading
    whose rank is about ``p``), and the exact columns of the parts."""
    if not probabilities or not all(0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities are between 0 and 1")
    ps = F.array(*[F.lit(float(p)) for p in probabilities])
    merged = merge_parts(parts, keys, k)
    # an empty sketch has no quantiles to give
    found = F.when(F.col("n_readings") > 0, F.kll_sketch_get_quantile_double("sketch", ps))
    none = F.array_repeat(F.lit(None).cast("double"), len(probabilities))
    both = F.arrays_zip(ps.alias("p"), F.coalesce(found, none).alias("quantile"))
    exact = ["n_readings", "n_missing", "lowest", "highest"]
    return merged.select(*keys, *exact, F.explode(both).alias("_q")).select(*keys, *exact, F.col("_q.p"), F.col("_q.quantile"))


def sketched_medians(parts: DataFrame, sensor_col: str = SENSOR, k: int = K) -> DataFrame:
    """``sensor, median`` for ``impute_median(medians=...)``."""
    return quantiles(parts, [0.5], [sensor_col], k).select(sensor_col, F.col("quantile").alias("median"))


def rank_errors(estimates: DataFrame, readings: DataFrame, keys: Sequence[str] = (SENSOR,), value_col: str = VALUE) -> DataFrame:
    """How far each estimate's rank is from its probability, counted over the
    readings (one pass; the estimates are one row a key and probability): 0
    if ``p`` lies between the shares of readings below and up to it. NULL
    where a key has no readings."""
    x = F.col(value_col).cast("double")
    wanted = estimates.groupBy(*keys).agg(F.collect_list(F.struct("p", "quantile")).alias("_e"))
    rows = readings.select(*keys, F.when(~F.isnan(x), x).alias("_x")).filter("_x is not null")
    each = rows.join(wanted, list(keys)).select(*keys, "_x", F.explode("_e").alias("_e"))
    p, q = F.col("_e.p"), F.col("_e.quantile")
    counted = each.groupBy(*keys, p.alias("p")).agg(
        F.avg((F.col("_x") < q).cast("double")).alias("_below"), F.avg((F.col("_x") <= q).cast("double")).alias("_up_to")
    )
    off = F.greatest(F.col("_below") - F.col("p"), F.col("p") - F.col("_up_to"), F.lit(0.0))
    return estimates.join(counted.select(*keys, "p", off.alias("rank_error")), [*keys, "p"], "left")
