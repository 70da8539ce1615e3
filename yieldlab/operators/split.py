"""Time-ordered train / validation / test split and label summaries."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import IDX, global_index

TRAIN_RATIO = 0.80
FIT_RATIO = 0.90  # share of the training rows used to fit; the rest validates

TRAIN, VALIDATION, TEST = "train", "validation", "test"


def split_points(n: int, train_ratio: float = TRAIN_RATIO, fit_ratio: float = FIT_RATIO):
    """``(fit_end, train_end)`` as in the reference: ``int(n * ratio)``."""
    train_end = int(math.floor(n * train_ratio))
    fit_end = int(math.floor(train_end * fit_ratio))
    return fit_end, train_end


def time_split(
    df: DataFrame,
    order: Sequence[str | Column],
    train_ratio: float = TRAIN_RATIO,
    fit_ratio: float = FIT_RATIO,
    split_col: str = "Split",
    index_col: str = "Split_Index",
) -> DataFrame:
    """Label each row ``train`` / ``validation`` / ``test`` by its position
    in time order: the first ``int(n * train_ratio)`` rows are training rows,
    of which the last ``1 - fit_ratio`` share validates (early stopping and,
    by default, threshold tuning). Never shuffles rows across time."""
    indexed, n = global_index(df, order)
    fit_end, train_end = split_points(n, train_ratio, fit_ratio)
    i = F.col(IDX)
    label = (
        F.when(i < F.lit(fit_end), F.lit(TRAIN))
        .when(i < F.lit(train_end), F.lit(VALIDATION))
        .otherwise(F.lit(TEST))
    )
    return indexed.withColumn(split_col, label).withColumnRenamed(IDX, index_col)


def label_summary(df: DataFrame, label_col: str = "Label", ts_col: str = "Timestamp") -> DataFrame:
    """Row count, fail/pass counts, failure rate (%) and time range."""
    lab = F.col(label_col)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(lab.cast("long")).alias("n_fail"),
        F.count_if(lab != 1).alias("n_pass"),
        F.round(F.lit(100.0) * F.avg(lab.cast("double")), 4).alias("failure_rate_pct"),
        F.min(ts_col).alias("first_time"),
        F.max(ts_col).alias("last_time"),
    )


def class_weight(df: DataFrame, label_col: str = "Label") -> DataFrame:
    """``n_neg / max(n_pos, 1)``: the weight given to each failing row."""
    lab = F.col(label_col)
    counts = df.agg(F.count_if(lab == 0).alias("n_neg"), F.count_if(lab == 1).alias("n_pos"))
    return counts.withColumn(
        "scale_pos_weight",
        F.col("n_neg").cast("double") / F.greatest(F.col("n_pos"), F.lit(1)).cast("double"),
    )
