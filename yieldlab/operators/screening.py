"""Per-sensor class-separation statistics (the feature-screening baselines
quoted in the dataset notes): signal-to-noise, Welch t, Pearson correlation
with the label and the two-group F statistic.

One aggregation pass keyed by sensor with per-class conditional moments;
partial aggregation keeps the shuffle at one row per sensor per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sensor_separation(
    long_df: DataFrame,
    label_col: str = "Label",
    sensor_col: str = "sensor_no",
    value_col: str = "value",
) -> DataFrame:
    x, y = F.col(value_col), F.col(label_col)
    x0 = F.when(y == 0, x)
    x1 = F.when(y == 1, x)
    agg = long_df.filter(x.isNotNull()).groupBy(sensor_col).agg(
        F.count(x0).alias("n_pass"),
        F.count(x1).alias("n_fail"),
        F.avg(x0).alias("_m0"),
        F.avg(x1).alias("_m1"),
        F.var_samp(x0).alias("_v0"),
        F.var_samp(x1).alias("_v1"),
        F.try_divide(
            F.covar_pop(x, y.cast("double")), F.stddev_pop(x) * F.stddev_pop(y.cast("double"))
        ).alias("_r"),
    )
    n0, n1 = F.col("n_pass").cast("double"), F.col("n_fail").cast("double")
    m0, m1, v0, v1 = (F.col(c) for c in ("_m0", "_m1", "_v0", "_v1"))
    diff = m1 - m0
    # NULL where both classes have no spread at all (a perfect separator, or a constant)
    s2n = F.try_divide(diff, F.sqrt(v0) + F.sqrt(v1))
    welch = F.try_divide(diff, F.sqrt(F.try_divide(v0, n0) + F.try_divide(v1, n1)))
    grand = F.try_divide(n0 * m0 + n1 * m1, n0 + n1)
    ssb = n0 * (m0 - grand) * (m0 - grand) + n1 * (m1 - grand) * (m1 - grand)
    ssw = (n0 - F.lit(1.0)) * v0 + (n1 - F.lit(1.0)) * v1
    f_stat = F.try_divide(ssb, F.try_divide(ssw, n0 + n1 - F.lit(2.0)))
    r9 = lambda c: F.round(c, 9)
    return agg.select(
        sensor_col,
        "n_pass",
        "n_fail",
        r9(s2n).alias("s2n"),
        r9(welch).alias("welch_t"),
        r9(F.col("_r")).alias("pearson_r"),
        r9(f_stat).alias("f_stat"),
    )
