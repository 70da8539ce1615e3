"""Tree attributions: brute-force Shapley values and additivity."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from yieldlab.operators import model as MD
from yieldlab.operators import treeshap as TS


def _random_tree(rnd, n_features, depth):
    nodes, counter = {}, [0]

    def grow(level, cover):
        nid = counter[0]
        counter[0] += 1
        if level == depth or rnd.random() < 0.15:
            nodes[nid] = (rnd.uniform(-1, 1), cover, -1, -1, 0, 0.0)
            return nid
        feat = rnd.randrange(n_features)  # features may repeat on a path
        left_cover = cover * rnd.uniform(0.2, 0.8)
        nodes[nid] = None
        left = grow(level + 1, left_cover)
        right = grow(level + 1, cover - left_cover)
        nodes[nid] = (0.0, cover, left, right, feat, rnd.uniform(-1, 1))
        return nid

    grow(0, 100.0)
    return {"weight": rnd.choice([1.0, 0.1]), "nodes": nodes}


def _cond_exp(tree, x, S, nid=0):
    pred, cover, left, right, feat, thr = tree["nodes"][nid]
    if left < 0:
        return pred
    if feat in S:
        return _cond_exp(tree, x, S, left if x[feat] <= thr else right)
    lc, rc = tree["nodes"][left][1], tree["nodes"][right][1]
    return (lc * _cond_exp(tree, x, S, left) + rc * _cond_exp(tree, x, S, right)) / cover


def _brute_shap(trees, x, M):
    phi = np.zeros(M)
    for i in range(M):
        rest = [j for j in range(M) if j != i]
        for k in range(M):
            for S in itertools.combinations(rest, k):
                w = math.factorial(k) * math.factorial(M - k - 1) / math.factorial(M)
                for t in trees:
                    gain = _cond_exp(t, x, set(S) | {i}) - _cond_exp(t, x, set(S))
                    phi[i] += w * t["weight"] * gain
    return phi


def test_tables_equal_brute_force():
    rnd = random.Random(11)
    M = 4
    trees = [_random_tree(rnd, M, 4) for _ in range(3)]
    tab = TS.build_leaf_tables(trees, M, scale=1.0)
    X = np.array([[rnd.uniform(-1.2, 1.2) for _ in range(M)] for _ in range(12)])
    got = TS.shap_matrix(X, tab)
    for row, x in enumerate(X):
        exp = _brute_shap(trees, x, M)
        assert np.allclose(got[row], exp, atol=1e-12)
        f = sum(t["weight"] * _cond_exp(t, x, set(range(M))) for t in trees)
        assert abs(tab.base + got[row].sum() - f) < 1e-12


def test_gbt_additivity_and_bundle_round_trip(spark, tmp_path):
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        a, b, c = rnd.gauss(0, 1), rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((i, a, b, c, 1 if a + 0.5 * b + rnd.gauss(0, 0.5) > 0.8 else 0))
    df = spark.createDataFrame(rows, "unit long, f1 double, f2 double, f3 double, Label int")
    df = MD.with_class_weight(df, "Label", 3.0).withColumn("is_validation", F.col("unit") >= 270)
    bundle = MD.train_gbt(df, ["f1", "f2", "f3"], params=MD.GBTParams(max_iter=15, max_depth=3, patience=3))
    assert bundle.meta["n_trees"] >= 1
    tab = TS.build_leaf_tables(TS.read_trees(spark, bundle.gbt, str(tmp_path / "trees")), 3)
    feats = df.withColumn("features_arr", F.array("f1", "f2", "f3")).withColumn("Wafer_ID", F.col("unit"))
    attr = TS.tree_attributions(feats, tab, ["f1", "f2", "f3"])
    sums = attr.groupBy("Wafer_ID").agg(F.sum("SHAP_Value").alias("s"))
    margin = bundle.model.transform(df).select(
        F.col("unit").alias("Wafer_ID"), (vector_to_array("rawPrediction")[1] * 2).alias("lo"))
    worst = margin.join(sums, "Wafer_ID", "left").select(
        F.max(F.abs(F.coalesce("s", F.lit(0.0)) + F.lit(tab.base) - F.col("lo")))).first()[0]
    assert worst < 1e-9

    bundle.threshold = 0.37
    MD.save_bundle(bundle, str(tmp_path / "bundle"))
    again = MD.load_bundle(spark, str(tmp_path / "bundle"))
    assert again.threshold == 0.37 and again.feature_names == ["f1", "f2", "f3"]
    a = MD.score(bundle, df).select("unit", "probability_fail").orderBy("unit").collect()
    b = MD.score(again, df).select("unit", "probability_fail").orderBy("unit").collect()
    assert a == b


def test_best_prefix_rule():
    assert MD.best_prefix([3, 2, 1, 2, 3, 4], 2) == (2, True)
    assert MD.best_prefix([3, 2, 1], 5) == (2, False)


def _brute_ap(scores, labels):
    P = sum(labels)
    ap = 0.0
    for t in sorted(set(scores), reverse=True):
        tp = sum(1 for s, y in zip(scores, labels) if s >= t and y == 1)
        n = sum(1 for s in scores if s >= t)
        pos_here = sum(1 for s, y in zip(scores, labels) if s == t and y == 1)
        ap += pos_here / P * tp / n
    return ap


def test_prefix_margins_and_validation_ap(spark, tmp_path):
    rnd = random.Random(8)
    rows = []
    for i in range(240):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((i, a, b, 1 if a - b + rnd.gauss(0, 1) > 0.5 else 0))
    df = spark.createDataFrame(rows, "unit long, f1 double, f2 double, Label int")
    bundle = MD.train_gbt(df, ["f1", "f2"], weight_col=None, validation_col=None,
                          params=MD.GBTParams(max_iter=6, max_depth=3))
    tab = TS.build_leaf_tables(TS.read_trees(spark, bundle.gbt, str(tmp_path / "t")), 2)
    X = np.array([[r[1], r[2]] for r in rows])
    m = TS.prefix_margins(X, tab)
    raw = [r.lo for r in bundle.model.transform(df).select(
        (vector_to_array("rawPrediction")[1] * 2).alias("lo")).collect()]
    assert np.allclose(m[:, -1], raw, atol=1e-9)
    feats = df.withColumn("fa", F.array("f1", "f2"))
    aps = TS.validation_average_precision(feats, tab, "fa", "Label")
    labels = [r[3] for r in rows]
    for k in (0, len(aps) - 1):
        assert abs(aps[k] - _brute_ap(list(m[:, k]), labels)) < 1e-12


def test_patience_on_average_precision(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.gauss(0, 1), 0) for i in range(200)]
    rows = [(i, x, 1 if x + rnd.gauss(0, 0.7) > 0.8 else 0) for i, x, _ in rows]
    df = spark.createDataFrame(rows, "unit long, f1 double, Label int").withColumn(
        "is_validation", F.col("unit") >= 160)
    b = MD.train_gbt(df, ["f1"], weight_col=None, params=MD.GBTParams(
        max_iter=8, max_depth=2, patience=3))
    assert b.meta["stopping_metric"] == "aucpr"
    curve = b.meta["validation_curve"]
    assert b.meta["best_iteration"] == int(np.argmin(curve[: b.meta["best_iteration"] + 1]))
    assert len(b.gbt.trees) == b.meta["best_iteration"] + 1


@pytest.mark.parametrize("depth", [8, 14])
def test_deep_paths_add_up(depth):
    rnd = random.Random(depth)
    M = depth + 2
    trees = [_random_tree(rnd, M, depth if depth < 10 else 11)]
    nodes, at = {}, 0  # and one chain of ``depth`` different features
    for level in range(depth):
        nodes[at] = (0.0, 100.0 * 0.7**level, at + 1, at + 2, level, rnd.uniform(-1, 1))
        nodes[at + 1] = (rnd.uniform(-1, 1), 30.0 * 0.7**level, -1, -1, 0, 0.0)
        at += 2
    nodes[at] = (1.0, 100.0 * 0.7**depth, -1, -1, 0, 0.0)
    trees.append({"weight": 1.0, "nodes": nodes})
    tab = TS.build_leaf_tables(trees, M, scale=1.0)
    assert tab.depth >= depth
    X = np.array([[rnd.uniform(-1.2, 1.2) for _ in range(M)] for _ in range(5)])
    got = TS.shap_matrix(X, tab)
    for row, x in enumerate(X):
        f = sum(t["weight"] * _cond_exp(t, x, set(range(M))) for t in trees)
        assert abs(tab.base + got[row].sum() - f) < 1e-9
    if depth == 8:
        assert np.allclose(got[0], _brute_shap(trees, X[0], M), atol=1e-9)


def test_model_learns_and_keeps_its_layout(spark):
    """Many trees, both classes, better than two trees, and the same model
    with another number of shuffle partitions."""
    rnd = random.Random(8)
    rows = []
    for i in range(1200):
        x = [rnd.gauss(0, 1) for _ in range(5)]
        rows.append((i, *x, 1 if x[0] + 0.8 * x[1] - 0.6 * x[2] * x[2] + rnd.gauss(0, 0.8) > 1.2 else 0))
    names = [f"f{j}" for j in range(5)]
    df = spark.createDataFrame(rows, "unit long, " + ", ".join(f"{n} double" for n in names) + ", Label int")
    train = df.filter("unit < 900").withColumn("is_validation", F.col("unit") >= 700)
    params = MD.GBTParams(max_iter=120)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    scores = []
    for n in ("3", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        b = MD.train_gbt(train.repartition(int(n)), names, weight_col=None, params=params)
        scores.append({r.unit: r.probability_fail for r in MD.score(b, df.filter("unit >= 900")).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(b.gbt.trees) > 20
    assert scores[0] == pytest.approx(scores[1])
    label = {r[0]: r[-1] for r in rows}

    def auc(s):
        pos, neg = ([v for u, v in s.items() if label[u] == y] for y in (1, 0))
        return np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])

    two = {r.unit: r.probability_fail for r in MD.score(MD.first_trees(b, 2), df.filter("unit >= 900")).collect()}
    assert auc(scores[0]) > auc(two) and auc(scores[0]) > 0.8
    assert min(scores[0].values()) < 0.5 < max(scores[0].values())
