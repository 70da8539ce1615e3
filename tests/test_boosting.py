"""Regularised boosting: every tree against a plain numpy grower, prefix
evaluation against the exact curve."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldlab.operators import boosting as B
from yieldlab.operators import model as MD
from yieldlab.operators import treeshap as TS


def sample(n=600, width=5, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).round(2)
    x[:, 1] = rng.integers(0, 6, n)
    x[rng.random(x.shape) < 0.1] = np.nan
    lean = np.where(np.isnan(x[:, 0]), 1.0, x[:, 0]) + 0.5 * (np.nan_to_num(x[:, 1]) > 3)
    y = (lean + rng.normal(size=n) * 0.7 > 0.8).astype(float)
    return x, y, np.where(y == 1, 2.5, 1.0)


def frame(spark, x, y, w, val=None):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], int(y[i]), float(w[i]), bool(val[i]) if val is not None else False) for i, r in enumerate(x)]
    cols = ", ".join(f"f{i} double" for i in range(x.shape[1]))
    return spark.createDataFrame(rows, f"unit long, {cols}, Label int, weight double, is_validation boolean")


def plain_tree(x, y, w, margins, cuts, p, columns):
    """Exact greedy growth over the given cuts, node by node."""
    prob = 1 / (1 + np.exp(-margins))
    g, h = (prob - y) * w, prob * (1 - prob) * w
    soft = lambda s: np.sign(s) * max(abs(s) - p.alpha, 0.0)
    part = lambda s, t: soft(s) ** 2 / (t + p.lam)
    nodes = {}

    def grow(i, rows, depth):
        sg, sh = g[rows].sum(), h[rows].sum()
        best = (1e-6, None)
        if depth < p.max_depth:
            for c in columns:
                v = x[rows, c]
                for b, cut in enumerate(cuts[c]):
                    for left in (False, True):
                        go = np.where(np.isnan(v), left, v <= cut)
                        gl, hl = g[rows][go].sum(), h[rows][go].sum()
                        if hl < p.min_child_weight or sh - hl < p.min_child_weight:
                            continue
                        gain = part(gl, hl) + part(sg - gl, sh - hl) - part(sg, sh)
                        if gain > best[0] + 1e-9:
                            best = (gain, (c, b, left, go))
        nodes[i] = [sg, sh, *best]
        if best[1] is not None:
            go = best[1][3]
            grow(2 * i + 1, rows[go], depth + 1)
            grow(2 * i + 2, rows[~go], depth + 1)
            if best[0] < p.gamma and all(nodes[j][3] is None for j in (2 * i + 1, 2 * i + 2)):
                nodes[i][3] = None

    grow(0, np.arange(len(y)), 0)
    values = {}

    def leaves(i, rows):
        sg, sh, _, split = nodes[i]
        if split is None:
            values[i] = -p.rate * soft(sg) / (sh + p.lam)
            margins[rows] += values[i]
            return
        leaves(2 * i + 1, rows[split[3]])
        leaves(2 * i + 2, rows[~split[3]])

    leaves(0, np.arange(len(y)))
    inner = {}

    def walk(i):
        if nodes[i][3] is not None:
            inner[i] = (nodes[i][3][0], nodes[i][3][1], nodes[i][2])
            walk(2 * i + 1)
            walk(2 * i + 2)

    walk(0)
    return inner, values


@pytest.mark.parametrize("per_partition", [10_000, 150])
def test_trees_equal_a_plain_grower(spark, per_partition):
    """Gains, splits and leaf values of several rounds, in one or more tasks."""
    x, y, w = sample()
    p = B.BoostParams(rounds=13, max_depth=3, subsample=1.0, colsample=0.8, max_bins=32, gamma=0.8, rows_per_partition=per_partition, rate=0.3)
    df = frame(spark, x, y, w)
    names = [f"f{i}" for i in range(5)]
    model = B.train_boosted(df, names, validation_col=None, params=p)
    cuts = B.quantile_cuts(df, names, p.max_bins)
    margins = np.zeros(len(y))
    assert len(model.trees) == 13
    pruned = 0
    for k, t in enumerate(model.trees):
        columns = np.sort(np.random.default_rng([p.seed, k]).permutation(5)[:4])
        inner, values = plain_tree(x, y, w, margins, cuts, p, columns)
        got = {i: (int(t.feature[i]), int(t.bin[i]), t.gain[i]) for i in B.reached(t) if t.feature[i] >= 0}
        assert set(got) == set(inner)
        pruned += 7 - len(got)
        for i, (c, b, gain) in inner.items():
            assert got[i][2] == pytest.approx(gain, rel=1e-9)
            assert got[i][:2] == (c, b)
        for i, v in values.items():
            assert t.value[i] == pytest.approx(v, rel=1e-9, abs=1e-12)
    assert pruned > 0
    scored = {r.unit: r.p for r in B.score(model, df, "p").select("unit", "p").collect()}
    assert max(abs(scored[i] - 1 / (1 + np.exp(-m))) for i, m in enumerate(margins)) < 1e-9


def exact_ap(scores, y):
    out, tp, n = 0.0, 0, 0
    for s in sorted(set(scores), reverse=True):
        here = scores == s
        tp, n, pos = tp + y[here].sum(), n + here.sum(), y[here].sum()
        out += pos * tp / n
    return out / y.sum() if y.sum() else 0.0


def test_stopping_equals_the_exact_curve(spark, monkeypatch):
    """Coarse histograms, refined only where needed, choose the same round."""
    monkeypatch.setattr(B, "SCORE_BINS", 4)
    monkeypatch.setattr(B, "FINER_BINS", 3)
    x, y, w = sample(900, 6, 4)
    val = np.arange(900) >= 600
    p = B.BoostParams(rounds=60, max_depth=3, rate=0.2, patience=12, min_child_weight=2.0, rows_per_partition=250)
    df = frame(spark, x, y, w, val)
    names = [f"f{i}" for i in range(6)]
    model = B.train_boosted(df, names, params=p)
    every = B.train_boosted(df.withColumn("is_validation", F.col("is_validation")), names, params=B.BoostParams(**{**p.__dict__, "patience": 1000}))
    assert len(every.trees) <= 60
    full = B.train_boosted(df.filter("not is_validation"), names, validation_col=None, params=p)
    trees = [(t.feature, t.threshold, t.missing_left, t.value) for t in full.trees]
    curve = [exact_ap(B.margins_of(x[val], trees[: k + 1], 0.0), y[val]) for k in range(60)]
    best, stopped = MD.best_prefix([-a for a in curve], p.patience)
    assert model.meta["best_iteration"] == best and len(model.trees) == best + 1
    assert len(model.meta["validation_bounds"]) >= (best + p.patience if stopped else 60)
    for (low, high), a in zip(model.meta["validation_bounds"], curve):
        assert low - 1e-12 <= a <= high + 1e-12
    assert every.meta["best_iteration"] == int(np.argmax(curve))


def test_precision_bounds_hold_for_random_groups():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = rng.integers(1, 60)
        y = (rng.random(n) < 0.4).astype(float)
        s = rng.normal(size=n).round(1)
        groups = B.score_groups(s, y, np.array([-np.inf, -1.0, 0.0, 0.2, 1.0, np.inf]))
        low, high = B.precision_bounds(groups)
        assert low - 1e-12 <= exact_ap(s, y) <= high + 1e-12
        fine = B.score_groups(s, y, np.append(np.unique(s), np.inf))
        assert B.precision_bounds(fine) == pytest.approx((exact_ap(s, y),) * 2)


def test_model_round_trip_and_attributions(spark, tmp_path):
    """Saved and loaded alike; attributions add up, missing readings included,
    and equal Shapley values by subsets."""
    x, y, w = sample(300, 3, 2)
    df, names = frame(spark, x, y, w), ["f0", "f1", "f2"]
    model = B.train_boosted(df, names, validation_col=None, params=B.BoostParams(rounds=12, max_depth=3, rate=0.3, min_child_weight=1.0))
    assert any(t.missing_left[t.feature >= 0].any() for t in model.trees)
    model.threshold = 0.31
    MD.save_bundle(model, str(tmp_path / "m"))
    again = MD.load_bundle(spark, str(tmp_path / "m"))
    assert (again.threshold, again.feature_names, again.meta["n_trees"]) == (0.31, names, 12)
    a, b = (MD.score(m, df).select("unit", "probability_fail").orderBy("unit").collect() for m in (model, again))
    assert a == b
    tables = TS.build_leaf_tables(model.node_tables(), 3, scale=1.0)
    phi = TS.shap_matrix(x, tables)
    trees = [(t.feature, t.threshold, t.missing_left, t.value) for t in model.trees]
    assert np.abs(tables.base + phi.sum(axis=1) - B.margins_of(x, trees, 0.0)).max() < 1e-9

    from itertools import combinations
    from math import factorial

    def value(t, row, known, i=0):
        if t.feature[i] < 0:
            return t.value[i]
        f = t.feature[i]
        if f in known:
            left = t.missing_left[i] if np.isnan(row[f]) else row[f] <= t.threshold[i]
            return value(t, row, known, 2 * i + 1 if left else 2 * i + 2)
        return (t.cover[2 * i + 1] * value(t, row, known, 2 * i + 1) + t.cover[2 * i + 2] * value(t, row, known, 2 * i + 2)) / t.cover[i]

    for row in (*x[:6], x[np.isnan(x).any(axis=1)][0]):
        for f in range(3):
            want = 0.0
            for size in range(3):
                for s in combinations([j for j in range(3) if j != f], size):
                    weight = factorial(size) * factorial(2 - size) / 6
                    want += weight * sum(value(t, row, {*s, f}) - value(t, row, set(s)) for t in model.trees)
            assert TS.shap_matrix(row[None], tables)[0, f] == pytest.approx(want, abs=1e-9)


def test_odd_input(spark):
    """No labels, one class, constant and empty features, null weights."""
    x, y, w = sample(80, 2, 3)
    df = frame(spark, x, y, w).withColumn("c", F.lit(3.0)).withColumn("e", F.lit(None).cast("double"))
    names = ["f0", "c", "e"]
    p = B.BoostParams(rounds=3, min_child_weight=1.0, colsample=1.0)
    model = B.train_boosted(df.withColumn("weight", F.when(F.col("unit") > 4, F.col("weight"))), names, params=p)
    assert {int(f) for t in model.trees for f in t.feature} <= {-1, 0}
    one = B.train_boosted(df.withColumn("Label", F.lit(0)), names, params=p)
    assert all((t.feature < 0).all() for t in one.trees)
    none = B.train_boosted(df.filter("false"), names, params=p)
    assert all((t.value == 0).all() for t in none.trees)
    assert B.score(model, df.withColumn("f0", F.lit(None).cast("double"))).filter("probability_fail between 0 and 1").count() == 80
    with pytest.raises(ValueError):
        B.train_boosted(df, names, params=B.BoostParams(max_bins=300))


def test_rows_of_a_round_are_a_share():
    keys = np.arange(200_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = (B.in_round(keys, k, 0.8, 42) for k in (0, 1))
    assert abs(a.mean() - 0.8) < 0.01 and abs((a & b).mean() - 0.64) < 0.01
