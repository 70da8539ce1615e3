"""Sensor selection baselines under cross-validation, as the dataset notes
quote them: the best ``top`` sensors by one of several criteria, a ridge
classifier on them, and its balanced error over the folds.

The rows are written once as arrays. Two passes over them (and one for the
means) do, whatever the number of methods and folds:

1. each task sums the products of its rows' columns for each fold, and the
   tasks' sums are added (a matrix a fold, so the size doesn't depend on the
   number of rows). What a fold trains on is the total less its own sums;
   ranking, orthogonalisation and the ridge weights come from these alone;
2. each row is classified by the models that haven't seen its fold, and the
   four counts are added.

A row's fold is the crc32 of its id's text modulo ``folds``; a NULL id is the
empty text. Rows without a label of 0 or 1 are left out. A missing reading
counts as its sensor's mean, and so does one beyond the end of a short array;
sensors constant in the training rows are never selected. Of equal criteria
the sensor that comes first wins. A rate of a class without rows in a fold is
NULL, and then so is the balanced error.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

METHODS = ("s2n", "ttest", "pearson", "ftest", "gram_schmidt")
TOP = 40
RIDGE = 0.1
FOLDS = 10
#: The matrices of all folds come to the driver: 8 bytes x folds x sensors^2.
MAX_SENSORS = 2500


def _centred(features: pd.Series, means: list) -> np.ndarray:
    mean = np.array(means)
    x = np.tile(mean, (len(features), 1))
    for i, row in enumerate(features):
        if row is not None:
            own = np.asarray(row, np.float64)[: len(mean)]
            x[i, : len(own)] = np.where(np.isfinite(own), own, mean[: len(own)])
    return x - mean


def _gram_task(frames: Iterator[pd.DataFrame], means: list) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    p = len(means)
    for frame in frames:
        x, y = _centred(frame["features"], means), frame["y"].to_numpy(np.float64)
        for fold in np.unique(frame["fold"]):
            own = (frame["fold"] == fold).to_numpy()
            z = np.column_stack([np.ones(own.sum()), y[own], x[own]])
            products = np.vstack([z.T @ z, np.r_[0.0, 0.0, y[own] @ x[own] ** 2]])
            sums[fold] = sums.get(fold, 0) + products
    for fold, s in sums.items():
        yield pd.DataFrame({"fold": fold, "i": range(p + 3), "v": list(s)})


def _add(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"fold": frame["fold"][:1], "i": frame["i"][:1], "v": [np.sum(np.stack(list(frame["v"])), axis=0)]})


class Moments:
    """Means, variances and correlations of the rows behind a sum of products
    (of ones, the label and the centred sensors; last the class-1 squares)."""

    def __init__(self, s: np.ndarray):
        self.n, self.n1 = s[0, 0], s[0, 1]
        self.n0 = self.n - self.n1
        total, ones, squares, ones_squares = s[0, 2:], s[1, 2:], np.diag(s[2:-1, 2:]), s[-1, 2:]
        self.mean = total / self.n
        self.m1, self.m0 = ones / max(self.n1, 1), (total - ones) / max(self.n0, 1)
        self.v1 = np.maximum(ones_squares - self.n1 * self.m1**2, 0) / max(self.n1 - 1, 1)
        self.v0 = np.maximum(squares - ones_squares - self.n0 * self.m0**2, 0) / max(self.n0 - 1, 1)
        var = squares / self.n - self.mean**2
        # below what rounding leaves of a constant
        self.varies = var > 1e-12 * np.maximum(squares / self.n, 1e-300)
        self.sd = np.where(self.varies, np.sqrt(np.maximum(var, 0)), 1.0)
        self.corr = (s[2:-1, 2:] / self.n - np.outer(self.mean, self.mean)) / np.outer(self.sd, self.sd)
        y = self.n1 / self.n
        self.with_label = (ones / self.n - self.mean * y) / self.sd
        self.r = self.with_label / np.sqrt(max(y * (1 - y), 1e-300))


def criterion(m: Moments, method: str) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        gap = np.abs(m.m1 - m.m0)
        if method == "s2n":
            c = gap / (np.sqrt(m.v1) + np.sqrt(m.v0))
        elif method == "ttest":
            c = gap / np.sqrt(m.v1 / m.n1 + m.v0 / m.n0)
        elif method == "pearson":
            c = np.abs(m.r)
        elif method == "ftest":
            c = m.r**2 * (m.n - 2) / np.maximum(1 - m.r**2, 0)
        else:
            raise ValueError(f"method is one of {', '.join(METHODS)}")
    return np.where(np.isnan(c), 0.0, c)


def forward(m: Moments, top: int) -> list[int]:
    """Gram-Schmidt: the sensor that explains most of what is left of the
    label; the others are then made orthogonal to it."""
    corr, cov, chosen = m.corr.copy(), m.with_label.copy(), []
    open_ = m.varies.copy()
    for _ in range(min(top, int(open_.sum()))):
        left = np.diag(corr)
        usable = open_ & (left > 1e-9)
        if not usable.any():
            break
        gain = np.where(usable, cov**2 / np.where(usable, left, 1.0), -1.0)
        s = int(np.argmax(gain))
        chosen.append(s)
        open_[s] = False
        part = corr[:, s] / corr[s, s]
        cov = cov - part * cov[s]
        corr = corr - np.outer(part, corr[s])
    return chosen


def select(m: Moments, method: str, top: int = TOP) -> list[int]:
    """Positions of the selected sensors, best first."""
    if method == "gram_schmidt":
        return forward(m, top)
    c = np.where(m.varies, criterion(m, method), -1.0)
    return [int(j) for j in np.argsort(-c, kind="stable")[:top] if m.varies[j]]


def ridge(m: Moments, chosen: list[int], penalty: float = RIDGE) -> tuple[np.ndarray, float]:
    """Weights of the centred sensors and the cut half-way between the mean
    scores of the two classes, so that a rare class counts as much."""
    w = np.zeros(len(m.mean))
    if chosen:
        a = m.corr[np.ix_(chosen, chosen)] + penalty * np.eye(len(chosen))
        w[chosen] = np.linalg.solve(a, m.with_label[chosen]) / m.sd[chosen]
    return w, float(w @ (m.m0 + m.m1) / 2)


def _count_task(frames: Iterator[pd.DataFrame], means: list, models: dict) -> Iterator[pd.DataFrame]:
    for frame in frames:
        x, y = _centred(frame["features"], means), frame["y"].to_numpy()
        rows = []
        for fold in np.unique(frame["fold"]):
            own = (frame["fold"] == fold).to_numpy()
            for method, (w, cut) in models[int(fold)].items():
                said = x[own] @ np.array(w) > cut
                hit = said == (y[own] == 1)
                rows.append((method, int(fold), *(int((hit[y[own] == c]).sum()) for c in (0, 1)), *(int((y[own] == c).sum()) for c in (0, 1))))
        yield pd.DataFrame(rows, columns=["method", "fold", "hit0", "hit1", "n0", "n1"])


def _prepared(units: DataFrame, id_col: str, features_col: str, label_col: str, folds: int) -> DataFrame:
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds
    rows = units.filter(F.col(label_col).isin(0, 1))
    return rows.select(fold.cast("int").alias("fold"), F.col(label_col).cast("int").alias("y"), F.col(features_col).cast("array<double>").alias("features"))


def gram_by_fold(rows: DataFrame) -> tuple[list[float], dict[int, np.ndarray]]:
    """The sensors' means and the sums of products of each fold's rows."""
    each = rows.select(F.posexplode("features").alias("pos", "v"))
    seen = F.when(~F.isnan("v") & (F.abs("v") < float("inf")), F.col("v"))
    width = rows.agg(F.max(F.size("features"))).first()[0] or 0
    if width > MAX_SENSORS:
        raise ValueError(f"{width} sensors; at most {MAX_SENSORS} go through matrices on the driver: screen them first")
    mean_of = {r.pos: r.m for r in each.groupBy("pos").agg(F.avg(seen).alias("m")).collect()}
    means = [mean_of.get(i) or 0.0 for i in range(max(width, 0))]
    parts = rows.mapInPandas(partial(_gram_task, means=means), "fold int, i int, v array<double>")
    added = parts.groupBy("fold", "i").applyInPandas(_add, "fold int, i int, v array<double>")
    sums: dict[int, np.ndarray] = {}
    for r in added.toLocalIterator():
        sums.setdefault(r.fold, np.zeros((width + 3, width + 2)))[r.i] = r.v
    return means, sums


def cross_validated(
    units: DataFrame,
    methods: Sequence[str] = METHODS,
    top: int = TOP,
    folds: int = FOLDS,
    penalty: float = RIDGE,
    id_col: str = "unit_no",
    features_col: str = "features",
    label_col: str = "Label",
) -> DataFrame:
    """A row for each method and fold: ``n_pass, n_fail, true_fail_rate,
    true_pass_rate, balanced_error_rate`` and ``selected``, the positions of
    the sensors chosen from the other folds, best first. Without rows there
    are none."""
    if folds < 2:
        raise ValueError("at least two folds")
    spark = units.sparkSession
    for method in methods:
        if method not in METHODS:
            raise ValueError(f"method is one of {', '.join(METHODS)}")
    # tasks travel by value, so that workers need no installed package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = materialize(_prepared(units, id_col, features_col, label_col, folds), "selection")
    means, sums = gram_by_fold(rows)
    models, chosen_rows = {}, []
    total = sum(sums.values()) if sums else None
    for fold, own in sums.items():
        train = total - own
        models[fold] = {}
        for method in methods:
            chosen, w, cut = [], np.zeros(len(means)), 0.0
            if train[0, 1] >= 1 and train[0, 0] - train[0, 1] >= 1:  # both classes
                m = Moments(train)
                chosen = select(m, method, top)
                w, cut = ridge(m, chosen, penalty)
            models[fold][method] = (w.tolist(), cut)
            chosen_rows.append((method, int(fold), chosen))
    counts = rows.mapInPandas(partial(_count_task, means=means, models=models), "method string, fold int, hit0 long, hit1 long, n0 long, n1 long")
    summed = counts.groupBy("method", "fold").agg(*[F.sum(c).alias(c) for c in ("hit0", "hit1", "n0", "n1")])
    right1, right0 = F.try_divide(F.col("hit1"), F.col("n1")), F.try_divide(F.col("hit0"), F.col("n0"))
    selected = spark.createDataFrame(chosen_rows, "method string, fold int, selected array<int>")
    return summed.join(F.broadcast(selected), ["method", "fold"]).select(
        "method", "fold", F.col("n0").alias("n_pass"), F.col("n1").alias("n_fail"), right1.alias("true_fail_rate"),
        right0.alias("true_pass_rate"), (F.lit(1.0) - (right1 + right0) / 2).alias("balanced_error_rate"), "selected",
    )


def summary(results: DataFrame) -> DataFrame:
    """Mean and sample spread over the folds, a row for each method."""
    cols = ("balanced_error_rate", "true_fail_rate", "true_pass_rate")
    return results.groupBy("method").agg(
        F.count("balanced_error_rate").alias("n_folds"),
        *[f(c).alias(f"{c}_{n}") for c in cols for f, n in ((F.avg, "mean"), (F.stddev_samp, "spread"))],
    )
