"""Near-duplicate vectors by E8 lattice hashing.

In each of several tables a random projection takes a unit vector to eight
dimensions, where the nearest point of the E8 lattice is its cell. A vector
also probes the cells of neighbouring lattice points (the 240 shortest
vectors away) that lie within ``RADIUS`` of its projection. Vectors that meet
in a cell, at least one of them its own, are compared by cosine in double
precision.

Equal vectors are one class. A cell leaves no pairs: each vector's number of
links, and a star to the smallest of each component. A pair that meets in
several tables or cells counts where it meets first, which both vectors'
projections tell. Cells with more than ``cell_rows`` rows are compared in
pairs of parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions
from .components import components
from .substring import mix

COSINE = 0.93
TABLES, SCALE, RADIUS, SEED = 8, 0.9, 1.15, 5
CELL_ROWS = 4000


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [v for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


ROOTS = _roots()


def _d8(y: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(y)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    if len(odd):
        off = y[odd] - near[odd]
        worst = np.abs(off).argmax(axis=1)
        near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def decode_e8(y: np.ndarray) -> np.ndarray:
    """The nearest point of E8 (integers with an even sum, or those moved by
    one half) for each row."""
    a, b = _d8(y), _d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1))[:, None], a, b)


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Tables:
    def __init__(self, dim: int, tables: int = TABLES, scale: float = SCALE, seed: int = SEED):
        rng = np.random.default_rng([seed, dim])
        self.turn = rng.normal(0.0, scale, (dim, tables * 8))
        self.shift = rng.uniform(0, 2, tables * 8)
        self.weights = [int(w) | 1 for w in rng.integers(1, 1 << 62, 8)]
        self.tables, self.salt = tables, [int(s) for s in rng.integers(0, 1 << 62, tables)]

    def project(self, u: np.ndarray) -> np.ndarray:
        """(rows, tables, 8), on a grid, so that every task has the same."""
        return (np.rint((u @ self.turn + self.shift) * (1 << 20)) / (1 << 20)).reshape(len(u), self.tables, 8)

    def cells(self, y: np.ndarray) -> np.ndarray:
        return decode_e8(y.reshape(-1, 8)).reshape(y.shape)

    def keys(self, cells: np.ndarray, table: np.ndarray, label: np.ndarray) -> np.ndarray:
        """A 64-bit key of (label, dimension, table, cell)."""
        h = np.zeros(len(cells), np.uint64)
        for j, w in enumerate(self.weights):
            h += (2 * cells[:, j]).astype(np.int64).view(np.uint64) * np.uint64(w)
        return mix(h ^ mix(label.view(np.uint64) + np.array(self.salt, np.uint64)[table]))

    def probes(self, y: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cells of the neighbours within the radius; y and cells are (rows, 8)."""
        e = y - cells
        row, root = np.nonzero(e @ ROOTS.T >= ((e * e).sum(axis=1)[:, None] + 2 - RADIUS**2) / 2)
        return row, cells[row] + ROOTS[root]


def _by_dim(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each dimension."""
    sizes, flat = np.asarray(column.value_lengths()), np.asarray(column.flatten())
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, flat[starts[rows][:, None] + np.arange(d)]


def _key_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made: dict[int, Tables] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            reps, labels = part.column(0).to_numpy(), part.column(1).to_numpy()
            for rows, x in _by_dim(part.column(2)):
                t = made.setdefault(x.shape[1], Tables(x.shape[1]))
                y = t.project(unit(x))
                cells = t.cells(y).reshape(-1, 8)
                table, who = np.tile(np.arange(t.tables), len(rows)), np.repeat(rows, t.tables)
                row, near = t.probes(y.reshape(-1, 8), cells)
                keys = np.concatenate([t.keys(cells, table, labels[who]), t.keys(near, table[row], labels[who[row]])])
                rep = np.concatenate([reps[who], reps[who[row]]])
                own = np.arange(len(keys)) < len(cells)
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(rep), pa.array(own)], ["key", "rep", "own"])


def _first_meeting(t: Tables, key: int, y: np.ndarray, c: np.ndarray, label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) that meet in the cell ``key`` meet here first."""
    first, open_ = np.zeros(len(i), bool), np.arange(len(i))
    for table in range(t.tables):
        if not len(open_):
            break
        a, b = i[open_], j[open_]
        ca, cb, ya, yb = c[a, table], c[b, table], y[a, table], y[b, table]
        close = ((ca - cb) ** 2).sum(axis=1) <= 2
        in_b = close & (((ya - cb) ** 2).sum(axis=1) <= RADIUS**2 + 1e-9)
        in_a = close & (((yb - ca) ** 2).sum(axis=1) <= RADIUS**2 + 1e-9)
        same = (ca == cb).all(axis=1)
        meet = in_a | in_b | same
        which = np.full(len(a), table)
        ka, kb = t.keys(ca, which, label[a]), t.keys(cb, which, label[b])
        here = np.where(same, ka, np.where(in_a & in_b, np.minimum(ka, kb), np.where(in_a, ka, kb)))
        first[open_[meet & (here == np.uint64(key & (1 << 64) - 1))]] = True
        open_ = open_[~meet]
    return first


def _compare(key: int, side: np.ndarray, rep: np.ndarray, label: np.ndarray, n: np.ndarray, own: np.ndarray, x: np.ndarray, t: Tables, least: float) -> Iterator[pa.RecordBatch]:
    """Link counts and stars of one cell, or of one pair of its parts:
    ``side`` is 0 or 1, and only rows of different sides are compared unless
    all are on side 0."""
    u = unit(x)
    y = t.project(u)
    c = t.cells(y)
    links = np.zeros(len(rep), np.int64)
    cross = bool(side.any())
    left = np.flatnonzero(side == 0) if cross else np.arange(len(rep))
    right = np.flatnonzero(side == 1) if cross else left
    step = max(1, 2_000_000 // max(len(right), 1))
    pairs = []
    for at in range(0, len(left), step):
        rows = left[at : at + step]
        near = u[rows] @ u[right].T >= least - 1e-9
        i, j = np.nonzero(near)
        i, j = rows[i], right[j]
        use = (own[i] | own[j]) & (label[i] == label[j]) & ((i < j) if not cross else True)
        i, j = i[use], j[use]
        if len(i):
            # the rounding of a block's product depends on its shape; this doesn't
            use = np.einsum("ij,ij->i", u[i], u[j]) >= least
            i, j = i[use], j[use]
        if not len(i):
            continue
        pairs.append((i, j))
        first = _first_meeting(t, key, y, c, label, i, j)
        np.add.at(links, i[first], n[j[first]])
        np.add.at(links, j[first], n[i[first]])
    if not pairs:
        return
    order = np.argsort(rep, kind="stable")  # so that a star's centre has the smallest id
    rank = np.argsort(order, kind="stable")
    label_of = np.arange(len(rep))
    while True:
        moved = False
        for i, j in pairs:
            a, b = rank[i], rank[j]
            low = np.minimum(label_of[a], label_of[b])
            if (label_of[a] != low).any() or (label_of[b] != low).any():
                np.minimum.at(label_of, a, low)
                np.minimum.at(label_of, b, low)
                moved = True
        label_of = label_of[label_of]
        if not moved:
            break
    centre = rep[order][label_of][rank]
    use = (links > 0) | (centre != rep)
    yield pa.record_batch([pa.array(rep[use]), pa.array(links[use]), pa.array(centre[use])], ["rep", "links", "centre"])


def _compare_task(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key and pair of parts."""
    made: dict[int, Tables] = {}

    def compare(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        key, a = rows.column(0)[0].as_py(), rows.column(1)[0].as_py()
        side = (rows.column(3).to_numpy() != a).astype(int)
        if rows.column(2)[0].as_py() != a and not side.any():
            return
        for which, x in _by_dim(rows.column(8)):
            t = made.setdefault(x.shape[1], Tables(x.shape[1]))
            cols = [rows.column(i).to_numpy(zero_copy_only=False)[which] for i in (4, 5, 6, 7)]
            yield from _compare(key, side[which], *cols, x, t, least)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
        cut = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
        if held and any(held[-1].column(i)[0].as_py() != key[0, i] for i in range(3)):
            yield from compare(_one(held))
            held = []
        for start, stop in zip(cut, cut[1:]):
            held.append(batch.slice(start, stop - start))
            if stop < len(key):
                yield from compare(_one(held))
                held = []
    if held:
        yield from compare(_one(held))


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def comparable(vec: Column) -> Column:
    """True for a vector with only finite components, not all zero."""
    whole = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vec.isNotNull() & whole & F.exists(vec, lambda v: v != 0), F.lit(False))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", least: float = COSINE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(id_col, n_links, component_id, kept)``, one row for each row.

    Only vectors with equal labels are compared, and only those with an id, a
    label, finite components and a length; others link with nothing
    (``n_links`` 0, component the own id). Rows with one id are rows of their
    own: each counts as a vector. Vectors of different dimensions never link.
    Other columns are ignored."""
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("lab"), F.col(vec_col).alias("v"))
    usable = src.filter(F.col("id").isNotNull() & F.col("lab").isNotNull() & comparable(F.col("v")))
    classes = usable.groupBy("lab", "v").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    classes = materialize(classes.withColumn("label", F.xxhash64("lab")), "classes")
    # A class is known by a number of its own: an id may occur in several.
    classes = materialize(classes.select("rep", F.xxhash64("lab", "v").alias("class"), "label", "n", "v"), "vectors")
    rows = classes.select("class", "label", "v").mapInArrow(_key_task, "key long, rep long, own boolean")
    met = rows.groupBy("key").agg(F.count("*").alias("rows"), F.max("own").alias("has")).filter("has and rows > 1").drop("has")
    parts = F.when(F.col("rows") > cell_rows, F.ceil(F.col("rows") / (cell_rows // 2))).otherwise(1).cast("int")
    dealt = rows.join(met, "key").withColumn("parts", parts)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumnRenamed("rep", "class").join(classes, "class")
    by = ["key", "pa", "pb"]
    dealt = dealt.select("key", F.least("part", "other").alias("pa"), F.greatest("part", "other").alias("pb"), "part", "class", "label", "n", "own", "v")
    dealt = dealt.repartition(partitions(vectors.sparkSession), *by).sortWithinPartitions(*by)
    found = materialize(dealt.mapInArrow(partial(_compare_task, least=least), "rep long, links long, centre long"), "vectorlinks")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    names = classes.select("class", "rep")
    stars = found.filter("rep <> centre").select("rep", "centre").distinct()
    stars = stars.join(names.toDF("rep", "a"), "rep").join(names.toDF("centre", "b"), "centre").select("a", "b")
    roots = components(stars)
    known = classes.join(links.withColumnRenamed("rep", "class"), "class", "left").join(roots, classes["rep"] == roots["node"], "left")
    known = known.select("class", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("root"))
    own = src.withColumn("class", F.when(F.col("lab").isNotNull() & F.col("id").isNotNull() & comparable(F.col("v")), F.xxhash64("lab", "v"))).select("id", "class")
    out = own.join(known, "class", "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
