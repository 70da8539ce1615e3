"""Column-level cleaning of sensor data: missing fraction, drop of sparse
sensors, exact median imputation, drop of constant sensors.

Work happens on the long form ``(unit, sensor, value)``: one aggregation
keyed by sensor replaces hundreds of per-column aggregate expressions, and
partial aggregation keeps every shuffle small. ``to_long`` / ``to_wide``
convert from / to the reference's wide layout.

Semantics (fixed to match the reference):

* missing = NULL (NaN tokens become NULL at load time);
* a sensor is dropped when its missing fraction is strictly above the
  threshold (0.5 kept);
* the median is exact: the mean of the two middle values for an even count;
* after imputation a sensor is constant when it has at least two readings
  and min == max (a single reading keeps the sensor, as pandas' NaN std does).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import sanitize_columns
from ..session import SMALL_SIDE_ROWS, materialize, small_side
from .ordering import IDX, global_index

SENSOR = "sensor_no"
UNIT = "unit_no"
VALUE = "value"
MISSING_DROP_THRESHOLD = 0.5


def to_long(
    wide: DataFrame, id_cols: Sequence[str], sensor_cols: Sequence[str] | None = None
) -> DataFrame:
    """Wide ``id..., Sensor_1..N`` -> ``id..., sensor, value`` (NULLs kept)."""
    sensors = list(sensor_cols) if sensor_cols else [c for c in wide.columns if c not in id_cols]
    return wide.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in sensors]).unpivot(
        list(id_cols), sensors, "sensor", VALUE
    )


def to_wide(
    long_df: DataFrame,
    id_cols: Sequence[str],
    sensors: Sequence,
    sensor_col: str = SENSOR,
    value_col: str = VALUE,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Long -> wide with one column per sensor in ``sensors`` order.

    The sensor list is passed in (it is known from a fitted cleaner), so the
    pivot needs no extra job to discover values.
    """
    wide = long_df.groupBy(*id_cols).pivot(sensor_col, list(sensors)).agg(F.first(value_col))
    if names:
        mapping = dict(zip([str(s) for s in sensors], names))
        wide = wide.select(
            *id_cols, *[F.col(str(s)).alias(mapping[str(s)]) for s in sensors]
        )
    return wide.toDF(*sanitize_columns(wide.columns))


def missing_fraction(
    long_df: DataFrame, sensor_col: str = SENSOR, value_col: str = VALUE
) -> DataFrame:
    return long_df.groupBy(sensor_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(value_col).isNull()).alias("n_missing"),
    ).withColumn("missing_fraction", F.col("n_missing") / F.col("n_rows"))


def drop_high_missing(
    long_df: DataFrame,
    threshold: float = MISSING_DROP_THRESHOLD,
    sensor_col: str = SENSOR,
    value_col: str = VALUE,
) -> DataFrame:
    keep = missing_fraction(long_df, sensor_col, value_col).filter(
        F.col("missing_fraction") <= F.lit(threshold)
    )
    return long_df.join(small_side(keep.select(sensor_col), "kept"), sensor_col, "left_semi")


def _medians_by_sort(vals: DataFrame, sensor_col: str, value_col: str, unit_col: str):
    """All readings get a dense position in (sensor, value, unit) order
    (range partitioned, so even a sensor with a third of all rows is spread
    over many tasks); the one or two middle positions are joined back."""
    indexed, _ = global_index(vals, [sensor_col, value_col, unit_col])
    bounds = indexed.groupBy(sensor_col).agg(
        F.min(IDX).alias("_start"), F.count(F.lit(1)).alias("_c")
    )
    lo = F.col("_start") + F.floor((F.col("_c") - 1) / 2).cast("long")
    hi = F.col("_start") + F.ceil((F.col("_c") - 1) / 2).cast("long")
    targets = bounds.select(sensor_col, F.explode(F.array_distinct(F.array(lo, hi))).alias(IDX))
    picked = indexed.join(targets, [sensor_col, IDX], "inner")
    return picked.groupBy(sensor_col).agg(
        ((F.min(value_col) + F.max(value_col)) / F.lit(2.0)).alias("median")
    )


def exact_medians(
    long_df: DataFrame,
    sensor_col: str = SENSOR,
    value_col: str = VALUE,
    unit_col: str = UNIT,
    method: str = "bracket",
    accuracy: int = 10000,
    margin: float | None = None,
) -> DataFrame:
    """Exact median per sensor (mean of the two middle readings for an even
    count) without sorting a whole sensor, or the whole table, in one place.

    ``method="sort"`` ranks every reading (one range shuffle of all data).
    ``method="bracket"`` (default) sorts a thin slice only:

    1. one aggregation pass: count and approximate quantiles ``0.5 -+ d``
       per sensor (``percentile_approx``, bounded buffers) -> ``[lo, hi]``;
    2. one counting pass: exact numbers of readings ``< lo``, ``= lo``,
       ``<= hi`` and ``= hi``, which fix the exact rank of every reading
       equal to ``lo`` or ``hi`` (ties cost nothing);
    3. only readings strictly between ``lo`` and ``hi`` (about ``2d`` of the
       data) are ranked, and the middle ranks are read off.

    A sensor whose bracket does not contain both middle ranks (the
    approximation missed) is handled by the sort method, so the result is
    always exact.
    """
    s, v, u = sensor_col, value_col, unit_col
    vals = long_df.filter(F.col(v).isNotNull()).select(s, v, u)
    if method == "sort":
        return _medians_by_sort(vals, s, v, u)
    d = margin if margin is not None else 10.0 / accuracy
    qs = [max(0.0, 0.5 - d), min(1.0, 0.5 + d)]
    # one row per sensor, written once so the later passes do not redo it
    br = materialize(
        vals.groupBy(s)
        .agg(F.count(F.lit(1)).alias("_c"), F.percentile_approx(v, qs, accuracy).alias("_q"))
        .select(s, "_c", F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi")),
        "median-bracket",
    )
    bounded = br.count() <= SMALL_SIDE_ROWS
    narrow = br.select(s, "_lo", "_hi")
    tagged = vals.join(F.broadcast(narrow) if bounded else narrow, s)
    x, lo_v, hi_v = F.col(v), F.col("_lo"), F.col("_hi")
    counts = tagged.groupBy(s).agg(
        F.count_if(x < lo_v).alias("_below"),
        F.count_if(x == lo_v).alias("_eq_lo"),
        F.count_if(x <= hi_v).alias("_upto"),
        F.count_if(x == hi_v).alias("_eq_hi"),
    )
    r_lo = F.floor((F.col("_c") - 1) / 2).cast("long")
    r_hi = F.ceil((F.col("_c") - 1) / 2).cast("long")
    plan = materialize(
        br.join(counts, s).select(
            s, "_lo", "_hi", "_below", "_eq_lo", "_upto", "_eq_hi",
            r_lo.alias("_r_lo"), r_hi.alias("_r_hi"),
        ).withColumn(
            "_ok", (F.col("_below") <= F.col("_r_lo")) & (F.col("_upto") > F.col("_r_hi"))
        ),
        "median-plan",
    )
    ok = plan.filter("_ok")
    # rank r -> value: lo below below+eq_lo, hi from upto-eq_hi, else inside
    first_inside = F.col("_below") + F.col("_eq_lo")
    last_inside = F.col("_upto") - F.col("_eq_hi")

    def at_rank(r):
        return (
            F.when(r < first_inside, F.col("_lo"))
            .when(r >= last_inside, F.col("_hi"))
        )

    inside = (
        tagged.filter((x > lo_v) & (x < hi_v))
        .join(F.broadcast(ok.select(s)) if bounded else ok.select(s), s, "left_semi")
        .select(s, v, u)
    )
    indexed, _ = global_index(inside, [s, v, u])
    starts = indexed.groupBy(s).agg(F.min(IDX).alias("_start"))
    wanted = ok.join(starts, s, "left").select(
        s,
        F.explode(F.array_distinct(F.array(
            F.col("_start") + F.col("_r_lo") - first_inside,
            F.col("_start") + F.col("_r_hi") - first_inside,
        ))).alias(IDX),
    )
    picked = indexed.join(wanted, [s, IDX], "inner").groupBy(s).agg(
        F.min(v).alias("_in_lo"), F.max(v).alias("_in_hi")
    )
    resolved = ok.join(picked, s, "left").select(
        s,
        (
            (F.coalesce(at_rank(F.col("_r_lo")), F.col("_in_lo"))
             + F.coalesce(at_rank(F.col("_r_hi")), F.col("_in_hi")))
            / F.lit(2.0)
        ).alias("median"),
    )
    missed = plan.filter(~F.col("_ok")).select(s)
    rest = _medians_by_sort(vals.join(missed, s, "left_semi"), s, v, u)
    return resolved.unionByName(rest)


def impute_median(
    long_df: DataFrame,
    medians: DataFrame | None = None,
    sensor_col: str = SENSOR,
    value_col: str = VALUE,
    unit_col: str = UNIT,
) -> DataFrame:
    """Replace NULL readings with the sensor's median (fitted on ``long_df``
    unless ``medians`` is given). Sensors without any reading stay NULL."""
    if medians is None:
        medians = exact_medians(long_df, sensor_col, value_col, unit_col)
    medians = small_side(medians.select(sensor_col, "median"), "medians")
    return (
        long_df.join(medians, sensor_col, "left")
        .withColumn(value_col, F.coalesce(F.col(value_col), F.col("median")))
        .drop("median")
    )


def constant_sensors(
    long_df: DataFrame, sensor_col: str = SENSOR, value_col: str = VALUE
) -> DataFrame:
    stats = long_df.groupBy(sensor_col).agg(
        F.count(value_col).alias("_n"), F.min(value_col).alias("_lo"), F.max(value_col).alias("_hi")
    )
    return stats.filter((F.col("_n") >= 2) & (F.col("_lo") == F.col("_hi"))).select(sensor_col)


def drop_zero_variance(
    long_df: DataFrame, sensor_col: str = SENSOR, value_col: str = VALUE
) -> DataFrame:
    constant = small_side(constant_sensors(long_df, sensor_col, value_col), "constant")
    return long_df.join(constant, sensor_col, "left_anti")


def remaining_missing(long_df: DataFrame, value_col: str = VALUE) -> DataFrame:
    return long_df.agg(F.count_if(F.col(value_col).isNull()).alias("remaining_missing"))


def top_variance_sensors(
    long_df: DataFrame, n: int = 50, sensor_col: str = SENSOR, value_col: str = VALUE
) -> DataFrame:
    """The ``n`` sensors with the largest sample variance (ties by sensor)."""
    return (
        long_df.groupBy(sensor_col)
        .agg(F.var_samp(value_col).alias("_v"))
        .filter(F.col("_v").isNotNull())
        .orderBy(F.desc("_v"), F.asc(sensor_col))
        .limit(n)
        .select(sensor_col, F.round("_v", 12).alias("variance"))
    )


@dataclass
class CleanerModel:
    """Fitted cleaning: the kept sensors and their medians (one row each)."""

    params: DataFrame  # sensor_col, median
    sensor_col: str = SENSOR
    value_col: str = VALUE

    def transform(self, long_df: DataFrame) -> DataFrame:
        return (
            long_df.join(self.params, self.sensor_col, "inner")
            .withColumn(self.value_col, F.coalesce(F.col(self.value_col), F.col("median")))
            .drop("median")
        )

    def sensors(self) -> list:
        """Kept sensor ids, sorted (bounded by the table width)."""
        return sorted(r[0] for r in self.params.select(self.sensor_col).collect())


def save_cleaner(cleaner: CleanerModel, path: str) -> None:
    """The kept sensors and their medians as a table."""
    cleaner.params.write.mode("overwrite").parquet(path)


def load_cleaner(spark, path: str, sensor_col: str = SENSOR, value_col: str = VALUE) -> CleanerModel:
    """The cleaner that ``save_cleaner`` wrote, to apply to new units."""
    return CleanerModel(small_side(spark.read.parquet(path), "cleaner"), sensor_col, value_col)


class SensorCleaner:
    """Fit on some rows (e.g. the training split), apply to any rows.

    ``fit`` runs: missing fraction -> drop sparse -> exact medians of the
    survivors -> drop sensors constant after imputation.
    """

    def __init__(
        self,
        missing_threshold: float = MISSING_DROP_THRESHOLD,
        sensor_col: str = SENSOR,
        value_col: str = VALUE,
        unit_col: str = UNIT,
    ):
        self.threshold = missing_threshold
        self.sensor_col, self.value_col, self.unit_col = sensor_col, value_col, unit_col

    def fit(self, long_df: DataFrame) -> CleanerModel:
        """One aggregation pass gives, per sensor, the missing fraction and
        the min/max of its readings; both drop rules follow from it (the
        median lies in [min, max], so constancy after imputation needs no
        median). Exact medians are then computed only for the survivors."""
        s, v, u = self.sensor_col, self.value_col, self.unit_col
        stats = long_df.groupBy(s).agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count(v).alias("_n"),
            F.min(v).alias("_lo"),
            F.max(v).alias("_hi"),
        )
        sparse = (F.col("_rows") - F.col("_n")) / F.col("_rows") > F.lit(self.threshold)
        # After imputation a sensor with >= 1 reading has _rows values in
        # [_lo, _hi]; it is constant when _rows >= 2 and _lo == _hi.
        # A sensor without readings stays all-NULL and is kept.
        const = (F.col("_n") >= 1) & (F.col("_rows") >= 2) & (F.col("_lo") == F.col("_hi"))
        keep = small_side(stats.filter(~sparse & ~const).select(s), "kept")
        med = exact_medians(long_df.join(keep, s, "left_semi"), s, v, u)
        params = small_side(keep.join(med, s, "left").select(s, "median"), "cleaner")
        return CleanerModel(params, s, v)


def clean_sensors(
    long_df: DataFrame, missing_threshold: float = MISSING_DROP_THRESHOLD
) -> DataFrame:
    """The reference's chain (fit and apply on the same rows)."""
    return SensorCleaner(missing_threshold).fit(long_df).transform(long_df)
