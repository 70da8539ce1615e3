"""Exact path-dependent tree attributions (Shapley values) for a Spark GBT
model, computed as a Spark job.

Model side (driver, bounded by the model: trees x 2^depth leaves):
each leaf of each tree becomes a rule -- per distinct feature on its path an
interval ``lo < x <= hi`` and a cover fraction ``z`` (product of
child/parent covers of the splits on that feature). With ``P`` the path
features, hit flags ``o`` and fractions ``z``, feature ``i`` receives

    leaf * (o_i - z_i) * sum_{S in P minus i} |S|!(|P|-|S|-1)!/|P|!
                                             * prod_{j in S} o_j
                                             * prod_{j not in S, j != i} z_j

The weights are a Beta integral, so the sum is the integral over t in [0, 1]
of ``prod_j (z_j (1 - t) + o_j t)`` for all j but i, a polynomial of degree
``|P| - 1`` that Gauss-Legendre quadrature with ``ceil(|P| / 2)`` nodes gives
exactly. The work is ``|P|^2`` a leaf and row, whatever the depth.

Data side (executors): the leaf rules are broadcast (trees x 2^depth rows of
``depth`` intervals); ``mapInPandas`` turns each Arrow batch of feature rows
into hit flags with numpy comparisons and adds the integrals per feature. Output is long:
``id..., feature_index, Sensor_Name, SHAP_Value`` (exact zeros omitted),
in log-odds units (Spark's margin is half the log-odds).
"""

from __future__ import annotations

import math
import os
import sys
import uuid
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

LOG_ODDS_SCALE = 2.0  # P(fail) = sigmoid(2 * margin) for Spark's logistic loss


@dataclass
class LeafTables:
    feat: np.ndarray  # int32 [L, D] feature index per path slot
    lo: np.ndarray  # float64 [L, D]
    hi: np.ndarray  # float64 [L, D]
    width: np.ndarray  # int32 [L] number of distinct path features
    z: np.ndarray  # float64 [L, D] cover fraction per path slot (1 where unused)
    base: float  # expected value (log-odds)
    n_features: int
    depth: int
    value: np.ndarray | None = None  # float64 [L] leaf value (log-odds, weighted)
    tree: np.ndarray | None = None  # int32 [L] tree index of the leaf
    n_trees: int = 0
    miss: np.ndarray | None = None  # bool [L, D] whether a missing reading keeps to the path


def hits(vals: np.ndarray, t, s: int, e: int) -> np.ndarray:
    """Whether readings ``[n, leaves, slots]`` keep to the paths of leaves ``s`` to ``e``."""
    return np.where(np.isnan(vals), t.miss[s:e], (vals > t.lo[s:e]) & (vals <= t.hi[s:e]))


def read_trees(spark: SparkSession, gbt_model, path: str | None = None) -> list[dict]:
    """Node tables of every tree, via the model's own persisted format.

    The model is written under the session's checkpoint folder (shared
    storage on a cluster) unless ``path`` is given.
    """
    if path is None:
        path = os.path.join(ensure_checkpoint_dir(spark), f"gbt-{uuid.uuid4().hex}")
    gbt_model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID",
        "nodeData.id",
        "nodeData.prediction",
        "nodeData.impurityStats",
        "nodeData.leftChild",
        "nodeData.rightChild",
        "nodeData.split.featureIndex",
        "nodeData.split.leftCategoriesOrThreshold",
    ).collect()
    weights = list(gbt_model.treeWeights)
    trees: list[dict] = [dict(weight=w, nodes={}) for w in weights]
    for r in rows:
        trees[r.treeID]["nodes"][r.id] = (
            float(r.prediction),
            float(r.impurityStats[0]),
            int(r.leftChild),
            int(r.rightChild),
            int(r.featureIndex),
            float(r.leftCategoriesOrThreshold[0]) if r.leftCategoriesOrThreshold else 0.0,
        )
    return trees


def _leaf_rules(tree: dict):
    """Yield ``(value, {feature: [lo, hi, z, missing]})`` for each leaf of one
    tree; ``missing`` says whether a missing reading takes the path's side of
    every split on the feature (nodes without a seventh entry send it right)."""
    nodes = tree["nodes"]
    children = {c for n in nodes.values() for c in (n[2], n[3]) if c >= 0}
    root = min(set(nodes) - children)
    stack = [(root, {})]
    while stack:
        nid, rule = stack.pop()
        pred, cover, left, right, feat, thr, *side = nodes[nid]
        missing_left = bool(side and side[0])
        if left < 0:
            yield pred, rule
            continue
        for child, go_left in ((left, True), (right, False)):
            frac = nodes[child][1] / cover if cover > 0 else 0.0
            new = {k: list(v) for k, v in rule.items()}
            lo, hi, z, missing = new.get(feat, [-math.inf, math.inf, 1.0, True])
            if go_left:
                hi = min(hi, thr)
            else:
                lo = max(lo, thr)
            new[feat] = [lo, hi, z * frac, missing and missing_left == go_left]
            stack.append((child, new))


def build_leaf_tables(trees: list[dict], n_features: int, scale: float = LOG_ODDS_SCALE) -> LeafTables:
    leaves = []
    tree_of = []
    base = 0.0
    for ti, t in enumerate(trees):
        for value, rule in _leaf_rules(t):
            v = scale * t["weight"] * value
            feats = sorted(rule)
            z = np.array([rule[f][2] for f in feats])
            base += v * float(np.prod(z)) if len(feats) else v
            leaves.append((v, feats, [rule[f][0] for f in feats], [rule[f][1] for f in feats], z, [rule[f][3] for f in feats]))
            tree_of.append(ti)
    depth = max([len(lf[1]) for lf in leaves] + [1])
    L = len(leaves)
    feat = np.zeros((L, depth), np.int32)
    lo = np.full((L, depth), -np.inf)
    hi = np.full((L, depth), np.inf)
    width = np.zeros(L, np.int32)
    zs = np.ones((L, depth))
    miss = np.ones((L, depth), bool)
    for k, (_, fs, los, his, z, ms) in enumerate(leaves):
        p = len(fs)
        width[k] = p
        feat[k, :p], lo[k, :p], hi[k, :p], zs[k, :p], miss[k, :p] = fs, los, his, z, ms
    values = np.array([lf[0] for lf in leaves], dtype=float)
    return LeafTables(
        feat, lo, hi, width, zs, base, n_features, depth,
        values, np.array(tree_of, dtype=np.int32), len(trees), miss,
    )


def prefix_margins(X: np.ndarray, t, max_cells: int = 4_000_000) -> np.ndarray:
    """Log-odds margins ``[n, n_trees]`` of every prefix of the ensemble:
    column ``k`` is the model made of trees ``0..k``. A row reaches the one
    leaf per tree whose whole path rule it satisfies."""
    n, T = X.shape[0], t.n_trees
    per_tree = np.zeros(n * T)
    L, D = t.feat.shape
    chunk = max(1, max_cells // max(n * D, 1))
    row_off = (np.arange(n, dtype=np.int64) * T)[:, None]
    for s in range(0, L, chunk):
        e = min(L, s + chunk)
        vals = X[:, t.feat[s:e]]
        used = np.arange(D)[None, :] < t.width[s:e, None]
        ok = hits(vals, t, s, e)
        reached = np.all(ok | ~used, axis=-1)  # n, C
        idx = (row_off + t.tree[s:e][None, :]).ravel()
        per_tree += np.bincount(idx, weights=(reached * t.value[s:e][None, :]).ravel(),
                                minlength=n * T)
    return np.cumsum(per_tree.reshape(n, T), axis=1)


def validation_average_precision(
    df: DataFrame, tables: LeafTables, features_col: str, label_col: str
) -> list[float]:
    """Average precision (area under the PR curve, step form) on ``df`` for
    every prefix of the ensemble, as a Spark job: margins per (row, prefix)
    in ``mapInPandas``, then one ordered pass of running counts over
    (prefix, score desc) with per-prefix offsets -- no prefix is ever held in
    one task."""
    from pyspark.sql import functions as F

    from .ordering import running_totals

    spark = df.sparkSession
    _ship_by_value()
    plain = dict(feat=tables.feat, lo=tables.lo, hi=tables.hi, width=tables.width,
                 value=tables.value, tree=tables.tree, n_trees=tables.n_trees, miss=tables.miss)
    bc = spark.sparkContext.broadcast(plain)
    schema = "k int, score double, y int"

    def run(batches):
        tab = SimpleNamespace(**bc.value)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            X = np.stack([np.asarray(v, dtype=float) for v in pdf[features_col]])
            m = prefix_margins(X, tab)
            n, T = m.shape
            y = (pdf[label_col].to_numpy() == 1).astype(np.int32)
            yield pd.DataFrame({"k": np.repeat(np.arange(T, dtype=np.int32)[None, :], n, 0).ravel(),
                                "score": m.ravel(), "y": np.repeat(y, T)})

    scores = df.select(features_col, label_col).mapInPandas(run, schema)
    per = scores.groupBy("k", "score").agg(
        F.sum("y").alias("pos"), F.count(F.lit(1)).alias("cnt")
    )
    cum = running_totals(per, [F.col("k").asc(), F.col("score").desc()], ["pos", "cnt"])
    # running counts restart at each prefix: subtract the totals of earlier prefixes
    tot = per.groupBy("k").agg(F.sum("pos").alias("P"), F.sum("cnt").alias("C"))
    from pyspark.sql import Window

    before = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("k", "P",
                     F.coalesce(F.sum("P").over(before), F.lit(0)).alias("_p0"),
                     F.coalesce(F.sum("C").over(before), F.lit(0)).alias("_c0"))
    prec = (F.col("pos_cum") - F.col("_p0")) / (F.col("cnt_cum") - F.col("_c0"))
    ap = cum.join(F.broadcast(off), "k").groupBy("k").agg(
        (F.sum(F.col("pos") * prec) / F.nullif(F.first("P"), F.lit(0))).alias("ap")
    )
    got = {r.k: (r.ap if r.ap is not None else 0.0) for r in ap.collect()}
    return [got.get(k, 0.0) for k in range(tables.n_trees)]


def shap_matrix(X: np.ndarray, t: LeafTables, max_cells: int = 4_000_000) -> np.ndarray:
    """Attributions ``[n, n_features]`` for the rows of ``X``."""
    n, F = X.shape[0], t.n_features
    phi = np.zeros(n * F)
    if n == 0:
        return phi.reshape(0, F)
    L, D = t.feat.shape
    chunk = max(1, max_cells // max(n * D, 1))
    nodes, weights = np.polynomial.legendre.leggauss(max(1, (D + 1) // 2))
    nodes, weights = (nodes + 1) / 2, weights / 2
    row_off = (np.arange(n, dtype=np.int64) * F)[:, None, None]
    for s in range(0, L, chunk):
        e = min(L, s + chunk)
        f = t.feat[s:e]
        vals = X[:, f]  # n, C, D
        used = np.arange(D)[None, :] < t.width[s:e, None]
        z = t.z[s:e]
        hit = (hits(vals, t, s, e) | ~used).astype(float)
        integral = np.zeros_like(hit)
        for x, w in zip(nodes, weights):
            factor = z * (1 - x) + hit * x  # 1 in unused slots
            before = np.ones_like(factor)
            after = np.ones_like(factor)
            np.cumprod(factor[:, :, :-1], axis=2, out=before[:, :, 1:])
            np.cumprod(factor[:, :, :0:-1], axis=2, out=after[:, :, -2::-1])
            integral += w * before * after
        contrib = t.value[s:e][None, :, None] * (hit - z) * integral * used
        idx = (row_off + f[None, :, :]).ravel()
        phi += np.bincount(idx, weights=contrib.ravel(), minlength=n * F)
    return phi.reshape(n, F)


SHAP_FIELDS = [
    T.StructField("feature_index", T.IntegerType()),
    T.StructField("Sensor_Name", T.StringType()),
    T.StructField("SHAP_Value", T.DoubleType()),
]


def _ship_by_value() -> None:
    """Executors need not have this package installed: the task function and
    ``shap_matrix`` travel inside the pickled task, and the broadcast holds
    only numpy arrays and builtins."""
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except (ImportError, AttributeError, ValueError):  # older cloudpickle: rely on install
        pass


def tree_attributions(
    df: DataFrame,
    tables: LeafTables,
    feature_names: list[str],
    features_col: str = "features_arr",
    id_cols: tuple[str, ...] = ("Wafer_ID",),
) -> DataFrame:
    """Long attributions for every row of ``df`` (``features_col`` is an
    ``ARRAY<DOUBLE>`` in model feature order)."""
    spark = df.sparkSession
    _ship_by_value()
    plain = dict(
        feat=tables.feat, lo=tables.lo, hi=tables.hi, width=tables.width,
        z=tables.z, value=tables.value, n_features=tables.n_features, miss=tables.miss,
    )
    bc = spark.sparkContext.broadcast((plain, list(feature_names)))
    id_fields = [df.schema[c] for c in id_cols]
    schema = T.StructType(id_fields + SHAP_FIELDS)

    def run(batches):
        fields, names = bc.value
        tab = SimpleNamespace(**fields)
        names_arr = np.array(names, dtype=object)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            X = np.stack([np.asarray(v, dtype=float) for v in pdf[features_col]])
            phi = shap_matrix(X, tab)
            r, c = np.nonzero(phi)
            out = {cid: pdf[cid].to_numpy()[r] for cid in id_cols}
            out["feature_index"] = c.astype(np.int32)
            out["Sensor_Name"] = names_arr[c]
            out["SHAP_Value"] = phi[r, c]
            yield pd.DataFrame(out)

    return df.select(*id_cols, features_col).mapInPandas(run, schema)
