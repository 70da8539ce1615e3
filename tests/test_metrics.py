"""Threshold sweep and metrics against brute-force definitions."""

import itertools
import random

import pytest

from yieldlab.operators import metrics as M


def _scored(spark, scores, labels):
    return spark.createDataFrame(list(zip(scores, labels)), "s double, y int")


def _brute_pr(scores, labels):
    P = sum(labels)
    out = {}
    for t in sorted(set(scores)):
        tp = sum(1 for s, y in zip(scores, labels) if s >= t and y == 1)
        fp = sum(1 for s, y in zip(scores, labels) if s >= t and y != 1)
        p = tp / (tp + fp) if tp + fp else 0.0
        r = tp / P if P else 1.0
        out[t] = (tp, fp, p, r, 2 * p * r / (p + r + 1e-9))
    return out


def _brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y != 1]
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [1, 2])
def test_pr_curve_and_auc_with_ties(spark, seed):
    rnd = random.Random(seed)
    scores = [round(rnd.random(), 1) for _ in range(200)]  # heavy ties
    labels = [1 if rnd.random() < s else 0 for s in scores]
    df = _scored(spark, scores, labels)
    got = {r.threshold: (r.tp, r.fp, r.precision, r.recall, r.f1)
           for r in M.pr_curve(df, "s", "y").collect()}
    exp = _brute_pr(scores, labels)
    assert got.keys() == exp.keys()
    for t in exp:
        assert got[t][:2] == exp[t][:2]
        assert all(abs(a - b) < 1e-12 for a, b in zip(got[t][2:], exp[t][2:]))
    best = M.best_f1_threshold(df, "s", "y").first()
    top = max(v[4] for v in exp.values())
    assert best.threshold == min(t for t, v in exp.items() if v[4] == top)
    auc = M.roc_auc(df, "s", "y").first().roc_auc
    assert abs(auc - _brute_auc(scores, labels)) < 1e-12


def test_no_positive_class(spark):
    df = _scored(spark, [0.1, 0.5, 0.9], [0, 0, 0])
    curve = M.pr_curve(df, "s", "y").collect()
    assert all(r.recall == 1.0 and r.precision == 0.0 for r in curve)
    assert M.best_f1_threshold(df, "s", "y").first().threshold == 0.1
    assert M.roc_auc(df, "s", "y").first().roc_auc is None


def test_all_scores_equal(spark):
    df = _scored(spark, [0.3] * 4, [1, 0, 1, 0])
    assert M.roc_auc(df, "s", "y").first().roc_auc == 0.5
    assert M.pr_curve(df, "s", "y").count() == 1


def test_confusion_and_report(spark):
    pred = spark.createDataFrame(
        [(0, 0), (0, 0), (0, 1), (1, 1), (1, 0), (1, 1)], "Actual_Result int, Predicted_Class int")
    cm = {(r.Actual, r.Predicted): r.n for r in M.confusion_matrix(pred).collect()}
    assert cm == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    rep = {r.label: r for r in M.classification_report(pred).collect()}
    assert rep["Fail"].precision == 2 / 3 and rep["Fail"].recall == 2 / 3
    assert rep["accuracy"].f1_score == 4 / 6 and rep["accuracy"].precision is None
    assert rep["weighted avg"].support == 6


def test_zero_cells_present(spark):
    pred = spark.createDataFrame([(0, 0)], "Actual_Result int, Predicted_Class int")
    assert M.confusion_matrix(pred).count() == 4
    rep = {r.label: r for r in M.classification_report(pred).collect()}
    assert rep["Fail"].precision == 0.0 and rep["Fail"].f1_score == 0.0


def test_threshold_applies_to_unrounded_score(spark):
    df = spark.createDataFrame([(1, 0.4999999,), (2, 0.5,)], "id long, p double")
    got = {r.id: r.Predicted_Class for r in M.apply_threshold(df, "p", 0.5).collect()}
    assert got == {1: 0, 2: 1}
