"""Selection baselines against numpy on the rows themselves."""

import os
import subprocess
import sys
import zlib

import numpy as np
import pytest

from yieldlab.operators import selection as S

SCHEMA = "unit_no long, features array<double>, Label int"


def make(seed=3, n=400, p=12):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.25).astype(int)
    x = rng.normal(size=(n, p)) * 10.0 ** rng.integers(-2, 3, p) + 1000 * rng.normal(size=p)
    for j, strength in ((2, 1.5), (5, 1.0), (7, 0.5)):
        x[:, j] += strength * y * x[:, j].std()
    x[:, 8] = x[:, 2] + 0.01 * x[:, 2].std() * rng.normal(size=n)  # nearly a copy
    x[:, 9] = 4.2  # constant
    return x, y


def frame(spark, x, y):
    rows = [(i, [None if v != v else float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(x, y, fold, method, top, penalty):
    """Selection and balanced error from the rows, without sums of products."""
    test = np.array([zlib.crc32(str(i).encode()) % 5 == fold for i in range(len(y))])
    x = np.where(np.isnan(x), np.nanmean(x, axis=0), x)
    a, b = x[~test], y[~test]
    ok = a.max(axis=0) > a.min(axis=0)
    z = (a - a.mean(axis=0)) / np.where(ok, a.std(axis=0), 1)
    a1, a0 = a[b == 1], a[b == 0]
    if method == "gram_schmidt":
        chosen, left, target = [], z.copy(), b - b.mean()
        while len(chosen) < min(top, ok.sum()):
            norm = (left**2).sum(axis=0)
            usable = ok & (norm / len(z) > 1e-9) & ~np.isin(np.arange(len(ok)), chosen)
            if not usable.any():
                break
            s = int(np.argmax(np.where(usable, (left.T @ target) ** 2 / np.where(usable, norm, 1), -1)))
            q = left[:, s] / np.sqrt(norm[s])
            left, target = left - np.outer(q, q @ left), target - q * (q @ target)
            chosen.append(s)
    else:
        with np.errstate(divide="ignore", invalid="ignore"):
            gap = np.abs(a1.mean(axis=0) - a0.mean(axis=0))
            r = np.array([np.corrcoef(a[:, j], b)[0, 1] if ok[j] else 0 for j in range(a.shape[1])])
            c = {
                "s2n": gap / (a1.std(axis=0, ddof=1) + a0.std(axis=0, ddof=1)),
                "ttest": gap / np.sqrt(a1.var(axis=0, ddof=1) / len(a1) + a0.var(axis=0, ddof=1) / len(a0)),
                "pearson": np.abs(r), "ftest": r**2 * (len(b) - 2) / (1 - r**2),
            }[method]
        chosen = [int(j) for j in np.argsort(-np.where(ok, c, -1), kind="stable")[:top] if ok[j]]
    zs = z[:, chosen]
    w = np.linalg.solve(zs.T @ zs / len(zs) + penalty * np.eye(len(chosen)), zs.T @ (b - b.mean()) / len(zs))
    cut = (zs[b == 1].mean(axis=0) @ w + zs[b == 0].mean(axis=0) @ w) / 2
    t = ((x[test] - a.mean(axis=0)) / np.where(ok, a.std(axis=0), 1))[:, chosen]
    said, truth = t @ w > cut, y[test] == 1
    rates = said[truth].mean(), (~said[~truth]).mean()
    return chosen, rates, 1 - sum(rates) / 2


@pytest.mark.parametrize("missing", [False, True])
def test_equals_numpy(spark, missing):
    x, y = make()
    if missing:
        x[::11, 3] = np.nan
    got = S.cross_validated(frame(spark, x, y), top=4, folds=5, penalty=0.1).collect()
    assert len(got) == 5 * len(S.METHODS)
    for r in got:
        chosen, rates, ber = plain(x, y, r.fold, r.method, 4, 0.1)
        assert r.selected == chosen, r.method
        assert (r.true_fail_rate, r.true_pass_rate) == pytest.approx(rates)
        assert r.balanced_error_rate == pytest.approx(ber)
    assert sum(r.n_pass + r.n_fail for r in got if r.method == "s2n") == len(y)


def test_orthogonalisation_passes_over_a_copy(spark):
    x, y = make()
    got = S.cross_validated(frame(spark, x, y), ["gram_schmidt", "pearson"], top=2, folds=5).collect()
    assert all(not {2, 8} <= set(r.selected) for r in got if r.method == "gram_schmidt")
    assert any({2, 8} <= set(r.selected) for r in got if r.method == "pearson")


def test_summary(spark):
    x, y = make()
    per_fold = S.cross_validated(frame(spark, x, y), ["s2n"], top=3, folds=5)
    one = S.summary(per_fold).first()
    errors = [r.balanced_error_rate for r in per_fold.collect()]
    assert one.n_folds == 5
    assert (one.balanced_error_rate_mean, one.balanced_error_rate_spread) == pytest.approx((np.mean(errors), np.std(errors, ddof=1)))
    assert one.balanced_error_rate_mean < 0.4


def test_odd_rows(spark):
    rows = [(None, [1.0, 2.0], 1), (1, None, 0), (2, [], 0), (3, [float("nan"), float("inf")], 1), (4, [5.0], None), (5, [3.0, 1.0], 2)]
    got = S.cross_validated(spark.createDataFrame(rows * 3, SCHEMA), folds=2).collect()
    assert {r.method for r in got} == set(S.METHODS)
    assert sum(r.n_pass + r.n_fail for r in got if r.method == "ttest") == 12
    one_class = S.cross_validated(spark.createDataFrame([(i, [float(i)], 0) for i in range(20)], SCHEMA), ["s2n"], folds=2).collect()
    assert all(r.selected == [] and r.balanced_error_rate is None and r.true_pass_rate is not None for r in one_class)
    assert S.cross_validated(spark.createDataFrame([], SCHEMA)).count() == 0
    for wrong in ({"methods": ["relief"]}, {"folds": 1}):
        with pytest.raises(ValueError):
            S.cross_validated(spark.createDataFrame(rows, SCHEMA), **wrong)


SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])  # the driver's only: workers start in a folder without the package
from yieldlab.operators import selection as S
from yieldlab.session import get_session

spark = get_session("local[2]", app_name="foreign", shuffle_partitions=2)
rows = [(i, [float(i % 7), float(i % 5)], i % 2) for i in range(40)]
print("rows", S.cross_validated(spark.createDataFrame(rows, sys.argv[2]), folds=2).count())
spark.stop()
"""


def test_workers_need_no_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, repo, SCHEMA], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 10" in out.stdout, out.stderr[-2000:]
