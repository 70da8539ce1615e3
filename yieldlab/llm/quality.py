"""Quality classifier: ridge regression on random Fourier features of
document statistics, with isotonic calibration.

A text becomes ``len(STATISTICS)`` numbers (lengths, shares of kinds of
characters, repetition of words and lines). Standardised, they go through
``WAVES`` random cosines, whose inner products approximate a Gaussian kernel.
Each partition sums its part of the normal equations, the parts are summed by
the cluster, and the ridge solution of the small system scores all texts. A
part of the labelled rows that the fit didn't see calibrates the scores by
pool-adjacent-violators on their sums in a fixed grid of scores.

Fitting takes at most ``LABELLED`` labelled rows (those with the smallest
hashes of their ids); all texts are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, remainder, small_batches, text_rows

WAVES, WIDTH, RIDGE, SEED = 256, 1.0, 1e-3, 11
LABELLED = 400_000
GRID = 1000  # steps of a score from 0 to 1 in calibration
THRESHOLD = 0.3

STATISTICS = (
    "log_words", "log_bytes", "word_length", "longest_word", "distinct_words", "repeats_next", "most_common",
    "upper", "digits", "space", "pipe", "exclaim", "marks", "other_punctuation", "not_ascii",
    "log_lines", "distinct_lines", "words_a_line", "words_with_marks", "upper_words", "line_ends_with_stop",
)

_CLASS = np.zeros(256, np.uint8)
for _i, _chars in enumerate((bytes(range(65, 91)), b"0123456789", b" \t\r\x0b\x0c", b"\n", b"|", b"!", b"#$%&*@^~<>=+_\\{}[]", b".,;:'\"()-?/`", bytes(range(97, 123))), 1):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 10
_MARKS = bytes.maketrans(b"#$%&*@^~<>=+_\\{}[]!|", b"#" * 20)


def statistics(data: bytes) -> list[float]:
    """The numbers of one text in UTF-8; zeros for an empty one."""
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=11) / len(data)
    distinct = set(words)
    sizes = list(map(len, words))
    repeats = sum(map(eq, words, words[1:])) / n
    # the share of the commonest of some words: those that a repetition would be of
    common = max(map(words.count, {words[0], words[n // 2], words[-1]})) / n
    lines = data.split(b"\n")
    own = set(lines)
    marked = sum(map(bytes.__contains__, data.translate(_MARKS).split(), [b"#"] * n)) / n
    shouts = sum(map(bytes.isupper, words)) / n
    ends = sum(line.endswith((b".", b"!", b"?")) for line in lines) / len(lines)
    return [
        np.log1p(n), np.log1p(len(data)), sum(sizes) / n, np.log1p(max(sizes)), len(distinct) / n, repeats, common,
        kinds[1], kinds[2], kinds[3], kinds[5], kinds[6], kinds[7], kinds[8], kinds[10],
        np.log1p(len(lines)), len(own) / len(lines), np.log1p(n / len(lines)), marked, shouts, ends,
    ]


def _statistics_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, rows = [], []

    def flush() -> pa.RecordBatch:
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(rows, pa.list_(pa.float64()))], ["id", "x"])

    for i, data in text_rows(batches, "id", "data"):
        ids.append(i)
        rows.append([float(v) for v in statistics(data or b"")])
        if len(ids) == 5000:
            yield flush()
            ids, rows = [], []
    if ids:
        yield flush()


class Waves:
    """Random Fourier features of standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, waves: int = WAVES, width: float = WIDTH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        d = len(mean)
        self.mean, self.spread = mean, np.where(spread > 0, spread, 1.0)
        self.turns = rng.normal(0.0, 1.0 / (width * np.sqrt(d)), (d, waves))
        self.shift = rng.uniform(0, 2 * np.pi, waves)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        out = np.cos(z @ self.turns + self.shift) * np.sqrt(2 / len(self.shift))
        return np.concatenate([out, np.ones((len(x), 1))], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(len(column), len(STATISTICS))


def _equations_task(batches: Iterator[pa.RecordBatch], waves: Waves) -> Iterator[pa.RecordBatch]:
    """This task's part of the normal equations, a row for each of theirs."""
    total = None
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            z = waves(_matrix(part.column(0)))
            y = part.column(1).to_numpy(zero_copy_only=False).astype(float)
            own = np.concatenate([z.T @ z, (z.T @ y)[:, None]], axis=1)
            total = own if total is None else total + own
    if total is not None:
        yield pa.record_batch([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "v"])


def _sum_rows(part: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"i": part["i"].iloc[:1], "v": [np.sum(part["v"].to_list(), axis=0)]})


def pool(x: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of the sums ``y`` of ``n`` rows at ascending ``x``:
    centres and values of its blocks."""
    blocks: list[list[float]] = []
    for xi, ni, yi in zip(x, n, y):
        blocks.append([xi * ni, ni, yi])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


class Classifier:
    def __init__(self, waves: Waves, weights: np.ndarray, at: np.ndarray, value: np.ndarray):
        self.waves, self.weights, self.at, self.value = waves, weights, at, value

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.waves(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        # a thousandth of the raw score tells apart what calibration ties
        return 0.999 * np.interp(raw, self.at, self.value) + 0.001 * np.clip(raw, 0, 1)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, x array<double>)`` of every row."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("data"))
    return src.mapInArrow(_statistics_task, "id long, x array<double>")


def fit(rows: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", labelled: int = LABELLED) -> Classifier:
    """Fit on ``rows`` (``document_statistics``) with the labels of training
    ids, those whose crc32 modulo 5 isn't 0: remainders 2 to 4 for the ridge,
    1 for calibration. Null labels and ids don't count. Without any label all
    scores are near 0.5."""
    spark = rows.sparkSession
    y = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"), remainder(id_col).alias("fold"))
    y = y.filter("id is not null and y is not null and fold <> 0")
    n = y.count()
    if n > labelled:  # a bounded sample, by hash
        y = y.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(labelled / n * (1 << 30)))
    known = materialize(rows.join(y, "id").select("x", "y", "fold"), "labelled")
    sums = known.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).toPandas().sort_values("i")
    if not len(sums):
        zeros = np.zeros(len(STATISTICS))
        return Classifier(Waves(zeros, zeros), np.zeros(WAVES + 1), np.array([0.0]), np.array([0.5]))
    waves = Waves(sums["m"].to_numpy(), sums["s"].to_numpy())

    def solve(part: DataFrame) -> np.ndarray:
        got = part.select("x", "y").mapInArrow(partial(_equations_task, waves=waves), "i int, v array<double>").groupBy("i").applyInPandas(_sum_rows, "i int, v array<double>").toPandas()
        if not len(got):
            return np.zeros(WAVES + 1)
        m = np.array(got.sort_values("i")["v"].to_list())
        a, b = m[:, :-1], m[:, -1]
        penalty = RIDGE * a[-1, -1] * np.eye(len(a)) / WAVES
        penalty[-1, -1] = 0
        return np.linalg.lstsq(a + penalty, b, rcond=None)[0]

    weights = solve(known.filter("fold <> 1"))

    @F.pandas_udf("double")
    def raw(x: pd.Series) -> pd.Series:
        return pd.Series(waves(np.array(x.to_list(), float).reshape(len(x), -1)) @ weights)

    grid = F.round(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), F.col("r"))) * GRID).cast("int")  # at most 3 * GRID + 1 rows
    held = known.filter("fold = 1").select(raw("x").alias("r"), "y").groupBy(grid.alias("g")).agg(F.avg("r").alias("r"), F.count("*").alias("n"), F.sum("y").alias("y")).toPandas().sort_values("g")
    if not len(held):
        return Classifier(waves, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    return Classifier(waves, weights, *pool(held["r"].to_numpy(), held["n"].to_numpy(float), held["y"].to_numpy(float)))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``(id_col, held_out, score, predicted)``, one row for each row.

    ``held_out``: the id's crc32 modulo 5 is 0 (a null id isn't). The score is
    the calibrated probability of label 1, ``predicted`` 1 from ``threshold``
    on. A null or blank text has statistics of zero and a score like any
    other. Labels, and columns besides the text, are no inputs of a score."""
    rows = materialize(document_statistics(docs, id_col, text_col), "statistics")
    model = fit(rows, labels, label_col, id_col)

    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(x.to_list(), float).reshape(len(x), -1)))

    held = F.coalesce(remainder("id") == 0, F.lit(False))
    out = rows.select(F.col("id").alias(id_col), held.alias("held_out"), score("x").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject: scored where
    they stand, so the texts aren't shuffled."""
    rows = materialize(document_statistics(docs, id_col, text_col), "statistics")
    model = fit(rows, labels, label_col, id_col)

    @F.pandas_udf("boolean")
    def good(text: pd.Series) -> pd.Series:
        if not len(text):
            return pd.Series([], dtype=bool)
        x = np.array([statistics((t or "").encode("utf-8", "surrogatepass")) for t in text], float)
        return pd.Series(model.score(x) >= threshold)

    return docs.filter(good(F.col(text_col)))
