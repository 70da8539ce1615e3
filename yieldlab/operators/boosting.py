"""Second-order boosted trees with regularisation, trained round by round.

Each feature is cut at quantiles into at most 255 bins (one byte a reading; the
last value of a byte is a missing reading). The rows are written once as blocks
of numpy arrays. A tree grows level by level: every task sums gradients and
hessians of its rows per (node, column, bin), the histograms of a group of
columns meet in one task, which finds the best split of each node, and only
those splits reach the driver. Nothing else depends on the number of rows.

For a node with sums G and H, L2 ``lam`` and L1 ``alpha``, its score is
``S(G)^2 / (H + lam)`` with ``S`` moving G towards 0 by ``alpha``; a split's
gain is what the children's scores exceed the node's by; its sides must have a
hessian sum of ``min_child_weight``; missing readings go to the side that gains
more. When the tree is grown, splits below ``gamma`` are cut back from the
leaves on. A leaf's value is ``-rate * S(G) / (H + lam)``.

Every ``ROUNDS`` rounds the margins are computed anew from the written blocks
and all trees and cached; between, tasks add the few trees since. A lost
executor's part is so always computed from the table, never from a chain of
rounds.

Early stopping follows the average precision (area under the precision-recall
curve, ties as one step) of the validation rows. Each prefix of the trees gets
one histogram of its scores, which bounds the figure from both sides; only the
bins that leave a comparison with the best round open are cut finer, until it
is decided. What travels is histograms, not a row for each tree and row.
"""

from __future__ import annotations

import json
import sys
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

MISSING = 255
BLOCK_ROWS = 4096
ROUNDS = 10
SCORE_BINS, FINER_BINS = 1024, 64
LEAST_GAIN = 1e-6


@dataclass
class BoostParams:
    rounds: int = 400
    max_depth: int = 5
    rate: float = 0.05
    subsample: float = 0.8  # rows of a round
    colsample: float = 0.6  # columns of a tree
    min_child_weight: float = 5.0
    gamma: float = 1.0
    alpha: float = 0.1
    lam: float = 1.0
    max_bins: int = 255
    patience: int = 30
    base_margin: float = 0.0
    seed: int = 42
    rows_per_partition: int = 200_000


@dataclass
class Tree:
    """Nodes in heap order; ``feature`` is -1 at leaves and unused nodes."""

    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    grad: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (1 << (depth + 1)) - 1
        zeros = [np.zeros(n) for _ in range(5)]
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.uint8), zeros[0], np.zeros(n, bool), *zeros[1:])

    def plain(self) -> tuple:
        """What tasks need to send binned rows down the tree."""
        return self.feature, self.bin, self.missing_left, self.value


@dataclass
class BoostedModel:
    trees: list[Tree]
    feature_names: list[str]
    threshold: float = 0.5
    meta: dict = field(default_factory=dict)

    @property
    def base_margin(self) -> float:
        return float(self.meta.get("base_margin", 0.0))

    def node_tables(self) -> list[dict]:
        """The trees as ``treeshap.build_leaf_tables`` takes them (log-odds)."""
        out = []
        for t in self.trees:
            nodes = {}
            stack = [0]
            while stack:
                i = stack.pop()
                leaf = t.feature[i] < 0
                left, right = (-1, -1) if leaf else (2 * i + 1, 2 * i + 2)
                nodes[i] = (float(t.value[i]), float(t.cover[i]), left, right, int(t.feature[i]), float(t.threshold[i]), bool(t.missing_left[i]))
                stack += [] if leaf else [left, right]
            out.append({"weight": 1.0, "nodes": nodes})
        return out

    def rows(self) -> list[tuple]:
        """``(tree, node, feature, bin, threshold, missing_left, value, cover, gain, grad)``."""
        out = []
        for k, t in enumerate(self.trees):
            for i in reached(t):
                out.append((k, i, int(t.feature[i]), int(t.bin[i]), float(t.threshold[i]), bool(t.missing_left[i]), float(t.value[i]), float(t.cover[i]), float(t.gain[i]), float(t.grad[i])))
        return out

    def split_table(self, spark: SparkSession) -> DataFrame:
        """One row for each node of each tree; leaves have no feature."""
        names = spark.createDataFrame(list(enumerate(self.feature_names)), "feature int, feature_name string")
        rows = spark.createDataFrame(self.rows(), NODE_SCHEMA)
        return rows.join(F.broadcast(names), "feature", "left")


NODE_SCHEMA = "tree int, node int, feature int, bin int, threshold double, missing_left boolean, value double, cover double, gain double, grad double"


def reached(t: Tree) -> list[int]:
    out, stack = [], [0]
    while stack:
        i = stack.pop()
        out.append(i)
        if t.feature[i] >= 0:
            stack += [2 * i + 2, 2 * i + 1]
    return out


# ---- what runs inside tasks ---------------------------------------------------


def shrink(g, alpha):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def node_score(g, h, lam, alpha):
    return shrink(g, alpha) ** 2 / (h + lam)


def descend(plain: tuple, bins: np.ndarray) -> np.ndarray:
    """Node of every column of ``bins`` (features x rows) in a tree."""
    feature, cut, missing_left, _ = plain
    n = bins.shape[1]
    node, at = np.zeros(n, np.int64), np.arange(n)
    for _ in range(max(1, int(len(feature)).bit_length() - 1)):
        f = feature[node]
        b = bins[np.maximum(f, 0), at]
        left = np.where(b == MISSING, missing_left[node], b <= cut[node])
        node = np.where(f < 0, node, 2 * node + 2 - left)
    return node


def add_trees(margins: np.ndarray, bins: np.ndarray, trees: list[tuple]) -> np.ndarray:
    for t in trees:
        margins = margins + t[3][descend(t, bins)]
    return margins


def in_round(keys: np.ndarray, number: int, share: float, seed: int) -> np.ndarray:
    """Whether a row takes part in a round, by a hash of its key."""
    if share >= 1:
        return np.ones(len(keys), bool)
    x = keys ^ np.uint64((number * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53) < share


def gradients(margins, y, w):
    p = 1.0 / (1.0 + np.exp(-margins))
    return (p - y) * w, np.maximum(p * (1 - p), 1e-16) * w


def histograms(blocks, since: list[tuple], grown: tuple, columns: np.ndarray, nodes: list[int], number: int, p: BoostParams) -> np.ndarray:
    """Sums ``[column, node, bin, (gradient, hessian)]`` of a task's blocks."""
    place = np.full(len(grown[0]), -1, np.int64)
    place[nodes] = np.arange(len(nodes))
    out = np.zeros((len(columns), len(nodes), 256, 2))
    size = len(nodes) * 256
    for bins, y, w, _, margins, keys, val in blocks:
        rows = np.flatnonzero(~val & in_round(keys, number, p.subsample, p.seed))
        own = bins[:, rows]
        where = place[descend(grown, own)]
        here = where >= 0
        rows, own, where = rows[here], own[:, here], where[here]
        g, h = gradients(add_trees(margins[rows], own, since), y[rows], w[rows])
        for i, c in enumerate(columns):
            code = where * 256 + own[c]
            out[i, :, :, 0] += np.bincount(code, g, size).reshape(-1, 256)
            out[i, :, :, 1] += np.bincount(code, h, size).reshape(-1, 256)
    return out


def best_splits(hist: np.ndarray, columns: np.ndarray, n_cuts: np.ndarray, p: BoostParams) -> list[tuple]:
    """For each node the best split among ``columns``: ``(gain, column, bin,
    missing_left, left G, left H, G, H)``; of equal gains the first column,
    the first bin, missing to the right. A node's sums come with it even if
    no split is allowed (gain -1)."""
    out = []
    for k in range(hist.shape[1]):
        best = None
        for i, c in enumerate(columns):
            g, h = hist[i, k, :, 0], hist[i, k, :, 1]
            total_g, total_h = g.sum(), h.sum()
            if best is None:
                best = (-1.0, int(c), 0, False, 0.0, 0.0, float(total_g), float(total_h))
            n = int(n_cuts[c])
            if not n:
                continue
            lg, lh = np.cumsum(g[:n]), np.cumsum(h[:n])
            parent = node_score(total_g, total_h, p.lam, p.alpha)
            for left in (False, True):
                gl, hl = (lg + g[MISSING], lh + h[MISSING]) if left else (lg, lh)
                gr, hr = total_g - gl, total_h - hl
                ok = (hl >= p.min_child_weight) & (hr >= p.min_child_weight) & (hl > 0) & (hr > 1e-12)
                gain = np.where(ok, node_score(gl, hl, p.lam, p.alpha) + node_score(gr, np.maximum(hr, 0), p.lam, p.alpha) - parent, -1.0)
                b = int(gain.argmax())
                if gain[b] > best[0]:
                    best = (float(gain[b]), int(c), b, left, float(gl[b]), float(hl[b]), float(total_g), float(total_h))
        out.append(best)
    return out


# ---- binning -------------------------------------------------------------------


def quantile_cuts(rows: DataFrame, features: list[str], max_bins: int) -> list[np.ndarray]:
    """At most ``max_bins - 1`` distinct cut values a feature; a reading is in
    the first bin whose cut it doesn't exceed. A feature with few distinct
    values is cut at each. The driver gets a few numbers a feature."""
    shares = [i / max_bins for i in range(1, max_bins)]
    found = rows.select(*[F.col(f).cast("double").alias(f"c{i}") for i, f in enumerate(features)])
    quantiles = found.stat.approxQuantile(found.columns, shares, 0.25 / max_bins)
    return [np.unique(np.array(q, np.float64)) if q else np.zeros(0) for q in quantiles]


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Readings (rows x features) -> bins (features x rows)."""
    out = np.full((x.shape[1], x.shape[0]), MISSING, np.uint8)
    for i, c in enumerate(cuts):
        there = ~np.isnan(x[:, i])
        out[i, there] = np.searchsorted(c, x[there, i], side="left")
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list<double> column as rows x features; nulls are NaN."""
    flat = column.flatten() if isinstance(column, pa.ListArray) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def written_blocks(rows: DataFrame, features: list[str], cuts: list[np.ndarray], label: str, weight: str | None, validation: str | None, per_partition: int) -> DataFrame:
    """Blocks of at most ``BLOCK_ROWS`` rows, written once. Rows are laid out
    by a hash of their readings, so blocks don't depend on the session."""
    _by_value()
    width = len(features)
    key = F.xxhash64(*[F.col(f).cast("double") for f in features], F.col(label).cast("double"))
    plain = rows.select(
        key.alias("key"), F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
        (F.coalesce(F.col(validation).cast("boolean"), F.lit(False)) if validation else F.lit(False)).alias("val"),
        F.array(*[F.col(f).cast("double") for f in features]).alias("x"),
    ).filter(F.col("y").isNotNull())
    n = max(1, -(-rows.count() // per_partition))
    laid = plain.repartition(n, "key").sortWithinPartitions("key", "val", "w")
    schema = pa.schema([("n", pa.int32()), *[(c, pa.binary()) for c in ("bins", "y", "w", "val", "key")]])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                get = lambda c: part.column(part.schema.get_field_index(c))  # noqa: E731, B023
                y, w = (get(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("y", "w"))
                val, key = get("val").to_numpy(zero_copy_only=False).astype(bool), get("key").to_numpy(zero_copy_only=False).astype(np.int64)
                bins = binned(matrix(get("x"), width), cuts)
                yield pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in (bins, y, w, val, key)]], schema=schema)

    return materialize(laid.mapInArrow(run, "n int, bins binary, y binary, w binary, val binary, key binary"), "boost-blocks")


# ---- early stopping ------------------------------------------------------------


def score_groups(margins: np.ndarray, y: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """``[bin, (positives, negatives, least, greatest)]`` of scores between
    ascending ``edges``."""
    at = np.clip(np.searchsorted(edges, margins, side="right") - 1, 0, len(edges) - 2)
    n = len(edges) - 1
    out = np.empty((n, 4))
    out[:, 0], out[:, 1] = np.bincount(at, y, n), np.bincount(at, 1 - y, n)
    out[:, 2], out[:, 3] = np.inf, -np.inf
    np.minimum.at(out[:, 2], at, margins)
    np.maximum.at(out[:, 3], at, margins)
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a + b
    out[..., 2], out[..., 3] = np.minimum(a[..., 2], b[..., 2]), np.maximum(a[..., 3], b[..., 3])
    return out


def open_groups(groups: np.ndarray) -> np.ndarray:
    """Groups whose order inside matters: several scores, not only negatives."""
    return (groups[:, 0] > 0) & (groups[:, 0] + groups[:, 1] > 1) & (groups[:, 2] < groups[:, 3])


def precision_bounds(groups: np.ndarray) -> tuple[float, float]:
    """Bounds of the average precision of groups in ascending order of score;
    equal when no group is open."""
    g = groups[(groups[:, 0] + groups[:, 1]) > 0][::-1]
    total = g[:, 0].sum()
    if not total:
        return 0.0, 0.0
    pos, neg = g[:, 0], g[:, 1]
    before_p, before_n = np.cumsum(pos) - pos, np.cumsum(neg) - neg
    tied = pos * (before_p + pos) / (before_p + pos + before_n + neg)
    wide = open_groups(g)
    # at best all positives tie before the negatives, at worst they follow one by one
    high = np.where(wide, pos * (before_p + pos) / np.maximum(before_p + pos + before_n, 1), tied)
    low = np.where(wide, pos * (before_p + 1) / (before_p + 1 + before_n + neg), tied)
    return float(low.sum() / total), float(high.sum() / total)


class Watch:
    """The best round so far. ``finer(requests)`` cuts open groups of rounds:
    ``{round: [(least, greatest), ...]}`` -> ``{round: groups}``."""

    def __init__(self, patience: int, finer):
        self.patience, self.finer = patience, finer
        self.best, self.groups, self.bounds = -1, {}, {}
        self.seen = 0

    def take(self, groups: list[np.ndarray]) -> bool:
        """The next rounds' groups; whether patience has run out."""
        for g in groups:
            self.groups[self.seen], self.bounds[self.seen] = g, precision_bounds(g)
            self.seen += 1
        for i in range(self.seen - len(groups), self.seen):
            if self.best < 0 or self._better(i):
                self._forget(self.best)
                self.best = i
            else:
                self._forget(i)
                if i - self.best >= self.patience:
                    return True
        return False

    def _forget(self, i: int) -> None:
        self.groups.pop(i, None)

    def _better(self, i: int) -> bool:
        while True:
            (low, high), (best_low, best_high) = self.bounds[i], self.bounds[self.best]
            if low > best_high:
                return True
            if high <= best_low:
                return False
            asked = {k: open_groups(self.groups[k]) for k in (i, self.best)}
            asked = {k: np.flatnonzero(wide) for k, wide in asked.items() if wide.any()}
            if not asked:
                return low > best_low
            parts = self.finer({k: [tuple(self.groups[k][b, 2:]) for b in at] for k, at in asked.items()})
            for k, at in asked.items():
                rest = np.delete(self.groups[k], at, axis=0)
                every = np.concatenate([rest, parts[k]])
                every = every[(every[:, 0] + every[:, 1]) > 0]
                self.groups[k] = every[np.argsort(every[:, 2], kind="stable")]
                self.bounds[k] = precision_bounds(self.groups[k])


# ---- training ------------------------------------------------------------------


def _by_value() -> None:
    """Tasks need no installed copy of this module."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _load(rows, width: int, base: float, trees: list[tuple]):
    for r in rows:
        bins = np.frombuffer(r.bins, np.uint8).reshape(width, -1)
        y, w = np.frombuffer(r.y), np.frombuffer(r.w)
        margins = add_trees(np.full(r.n, base), bins, trees)
        yield bins, y, w, None, margins, np.frombuffer(r.key, np.uint64), np.frombuffer(r.val, bool)


class Trainer:
    """Blocks in the cluster and the trees so far."""

    def __init__(self, blocks: DataFrame, width: int, n_cuts: np.ndarray, cuts: list[np.ndarray], params: BoostParams):
        self.blocks, self.width, self.cuts, self.n_cuts, self.p = blocks, width, cuts, n_cuts, params
        self.trees: list[Tree] = []
        self.based = 0  # trees that the cached margins hold
        self.rdd = None
        self.rebase()

    def rebase(self) -> None:
        """Cache margins by all trees, computed from the written blocks."""
        trees, width, base = [t.plain() for t in self.trees], self.width, self.p.base_margin
        old = self.rdd
        self.rdd = self.blocks.rdd.mapPartitions(lambda rows: _load(rows, width, base, trees)).persist()
        self.based = len(self.trees)
        if old is not None:
            old.unpersist()

    def columns(self, number: int) -> np.ndarray:
        n = max(1, int(self.width * self.p.colsample))
        return np.sort(np.random.default_rng([self.p.seed, number]).permutation(self.width)[:n])

    def level(self, grown: Tree, columns: np.ndarray, nodes: list[int]) -> list[tuple]:
        """The best split of each of ``nodes``: one aggregation of histograms."""
        since, plain = [t.plain() for t in self.trees[self.based :]], grown.plain()
        number, p, n_cuts = len(self.trees), self.p, self.n_cuts
        tasks = self.rdd.getNumPartitions()
        groups = [c for c in np.array_split(columns, min(tasks, len(columns))) if len(c)]
        hist = lambda blocks: histograms(blocks, since, plain, columns, nodes, number, p)
        if tasks == 1:  # the sums of all rows are there at once
            found = [self.rdd.mapPartitions(lambda b: [best_splits(hist(b), columns, n_cuts, p)]).collect()[0]]
        else:

            def parts(blocks):
                sums = hist(blocks)
                for i, c in enumerate(groups):
                    at = np.searchsorted(columns, c)
                    yield i, sums[at]

            summed = self.rdd.mapPartitions(parts).reduceByKey(lambda a, b: a + b, len(groups))
            found = [s for _, s in sorted(summed.map(lambda kv: (kv[0], best_splits(kv[1], groups[kv[0]], n_cuts, p))).collect())]
        return [max(of, key=lambda s: s[0]) for of in zip(*found)]  # the first group wins ties

    def grow(self) -> Tree:
        """One more tree."""
        p, t = self.p, Tree.empty(self.p.max_depth)
        columns, nodes = self.columns(len(self.trees)), [0]
        for depth in range(p.max_depth + 1):
            if not nodes:
                break
            if depth == p.max_depth:
                break
            after = []
            for i, (gain, c, b, left, gl, hl, g, h) in zip(nodes, self.level(t, columns, nodes)):
                t.grad[i], t.cover[i] = g, h
                if gain <= LEAST_GAIN:
                    continue
                t.feature[i], t.bin[i], t.threshold[i], t.missing_left[i], t.gain[i] = c, b, self.cuts[c][b], left, gain
                t.grad[2 * i + 1], t.cover[2 * i + 1] = gl, hl
                t.grad[2 * i + 2], t.cover[2 * i + 2] = g - gl, h - hl
                after += [2 * i + 1, 2 * i + 2]
            nodes = after
        prune(t, p)
        self.trees.append(t)
        return t

    def validation(self, first: int, last: int) -> list[np.ndarray]:
        """Score groups of the validation rows by the first ``k + 1`` trees, for
        ``k`` from ``first`` to ``last - 1``; the cached margins hold ``first``."""
        trees = [t.plain() for t in self.trees[first:last]]
        edges = np.append(np.append(-np.inf, np.log(np.arange(1, SCORE_BINS) / (SCORE_BINS - np.arange(1, SCORE_BINS)))), np.inf)

        def run(blocks):
            out = None
            for bins, y, _, _, margins, _, val in blocks:
                rows = np.flatnonzero(val)
                m, own, sums = margins[rows], bins[:, rows], []
                for t in trees:
                    m = m + t[3][descend(t, own)]
                    sums.append(score_groups(m, y[rows], edges))
                out = np.array(sums) if out is None else merged(out, np.array(sums))
            return [] if out is None else [out]

        return list(self.rdd.mapPartitions(run).treeReduce(merged))

    def finer(self, requests: dict[int, list[tuple[float, float]]]) -> dict[int, np.ndarray]:
        """Groups of the asked score ranges, cut into ``FINER_BINS`` each; sent
        are ranges and histograms only."""
        trees, wanted, base, width = [t.plain() for t in self.trees], sorted(requests), self.p.base_margin, self.width
        edges = {k: [np.linspace(a, b, FINER_BINS + 1) for a, b in requests[k]] for k in wanted}

        def run(rows):
            out = {}
            for bins, y, _, _, m, _, val in _load(rows, width, base, []):
                at = np.flatnonzero(val)
                m, own, y = m[at], bins[:, at], y[at]
                for k, t in enumerate(trees[: wanted[-1] + 1]):
                    m = m + t[3][descend(t, own)]
                    if k not in requests:
                        continue
                    sums = []
                    for (a, b), e in zip(requests[k], edges[k]):
                        here = (m >= a) & (m <= b)
                        sums.append(score_groups(m[here], y[here], e))
                    sums = np.concatenate(sums)
                    out[k] = merged(out[k], sums) if k in out else sums
            return [out] if out else []

        both = lambda a, b: {k: merged(a[k], b[k]) for k in a}
        return self.blocks.rdd.mapPartitions(run).treeReduce(both)


def prune(t: Tree, p: BoostParams) -> None:
    """Cut back splits below ``gamma`` from the leaves on; set values."""
    for i in range(len(t.feature) - 1, -1, -1):
        if t.feature[i] >= 0 and t.gain[i] < p.gamma and t.feature[2 * i + 1] < 0 and t.feature[2 * i + 2] < 0:
            t.feature[i], t.gain[i] = -1, 0.0
    inside = set(reached(t))
    for i in range(len(t.feature)):
        if i in inside:
            t.value[i] = -p.rate * float(shrink(t.grad[i], p.alpha)) / (t.cover[i] + p.lam)
        else:
            t.value[i] = t.cover[i] = t.grad[i] = 0.0


def train_boosted(
    rows: DataFrame, feature_cols: list[str], label_col: str = "Label", weight_col: str | None = "weight",
    validation_col: str | None = "is_validation", params: BoostParams | None = None,
) -> BoostedModel:
    """Fit on the rows whose ``validation_col`` isn't true; those where it is
    stop the rounds. Rows without a label are left out, null and NaN readings
    are missing, a null weight counts 0."""
    p = params or BoostParams()
    if not 2 <= p.max_bins <= MISSING:
        raise ValueError(f"max_bins must be between 2 and {MISSING}")
    _by_value()
    features = list(feature_cols)
    watched = validation_col if validation_col and validation_col in rows.columns else None
    if weight_col:
        rows = rows.withColumn(weight_col, F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)))
    fit = rows.filter(~F.coalesce(F.col(watched).cast("boolean"), F.lit(False))) if watched else rows
    cuts = quantile_cuts(fit, features, p.max_bins)
    blocks = written_blocks(rows, features, cuts, label_col, weight_col, watched, p.rows_per_partition)
    trainer = Trainer(blocks, len(features), np.array([len(c) for c in cuts]), cuts, p)
    watch = Watch(p.patience, trainer.finer)
    watching = bool(watched) and rows.filter(F.col(watched).cast("boolean")).limit(1).count() > 0
    curve: list[tuple[float, float]] = []
    while len(trainer.trees) < p.rounds:
        first = len(trainer.trees)
        for _ in range(min(ROUNDS, p.rounds - first)):
            trainer.grow()
        if watching and watch.take(trainer.validation(first, len(trainer.trees))):
            break
        trainer.rebase()
    trainer.rdd.unpersist()
    best = watch.best if watching else len(trainer.trees) - 1
    curve = [watch.bounds[i] for i in range(watch.seen)]
    meta = {
        "kind": "boosted", "params": asdict(p), "n_trees": best + 1, "base_margin": p.base_margin, "best_iteration": best,
        "stopping_metric": "aucpr", "validation_curve": [(a + b) / 2 for a, b in curve], "validation_bounds": curve,
    }
    return BoostedModel(trainer.trees[: best + 1], features, 0.5, meta)


# ---- scoring, saving -------------------------------------------------------------


def margins_of(x: np.ndarray, trees: list[tuple], base: float) -> np.ndarray:
    """Log-odds of readings (rows x features) by the thresholds themselves."""
    out, at = np.full(len(x), base), np.arange(len(x))
    for feature, threshold, missing_left, value in trees:
        node = np.zeros(len(x), np.int64)
        for _ in range(int(len(feature)).bit_length() - 1):
            f = feature[node]
            v = x[at, np.maximum(f, 0)]
            left = np.where(np.isnan(v), missing_left[node], v <= threshold[node])
            node = np.where(f < 0, node, 2 * node + 2 - left)
        out += value[node]
    return out


def score(model: BoostedModel, df: DataFrame, out_col: str = "probability_fail") -> DataFrame:
    """Add the failure probability; only the features go to Python."""
    from pyspark.sql.functions import arrow_udf

    _by_value()
    trees = [(t.feature, t.threshold, t.missing_left, t.value) for t in model.trees]
    base, width = model.base_margin, len(model.feature_names)

    @arrow_udf("double")
    def probability(x: pa.Array) -> pa.Array:
        return pa.array(1.0 / (1.0 + np.exp(-margins_of(matrix(x, width), trees, base))))

    return df.withColumn(out_col, probability(F.array(*[F.col(c).cast("double") for c in model.feature_names])))


def save(model: BoostedModel, path: str) -> None:
    """The nodes as Parquet under ``path/trees``; the rest as JSON under
    ``path/meta``."""
    spark = SparkSession.getActiveSession()
    spark.createDataFrame(model.rows(), NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
    meta = json.dumps({"threshold": model.threshold, "feature_names": model.feature_names, **model.meta})
    spark.createDataFrame([(meta,)], "meta STRING").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load(spark: SparkSession, path: str, meta: dict) -> BoostedModel:
    """The model that ``save`` wrote; ``meta`` is its JSON."""
    threshold, names = float(meta.pop("threshold")), list(meta.pop("feature_names"))
    depth = int(meta["params"]["max_depth"])
    trees = [Tree.empty(depth) for _ in range(int(meta["n_trees"]))]
    for r in spark.read.parquet(f"{path}/trees").collect():  # bounded by the model
        t = trees[r.tree]
        for name in ("feature", "bin", "threshold", "missing_left", "value", "cover", "gain", "grad"):
            getattr(t, name)[r.node] = r[name]
    return BoostedModel(trees, names, threshold, meta)
