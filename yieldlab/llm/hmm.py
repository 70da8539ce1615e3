"""Language-model scores from a hidden Markov model.

Text is lower-cased (A-Z), split at ASCII white space, and ends with an end
token. A latent state emits a token's class, and the class its token by the
token's share of the class: a word with at least ``FREQUENT`` of all training
tokens is a class of its own, any other belongs to one of ``BUCKETS`` classes
by its last bytes. So the table of states and classes is bounded
(``1 / FREQUENT + BUCKETS`` rows), while the counts of all words stay a table
of the cluster, however many there are.

1. Documents are written once as chunks of some two million tokens: the
   chunk's own vocabulary (64-bit word hashes) and tokens as numbers in it.
2. Training counts of all words: one aggregation over the vocabularies.
3. Baum-Welch: each task runs the scaled forward and backward recursions over
   its chunks, all sequences in step, and hands on its expected counts once;
   they are summed over partitions. Documents are cut into sequences of
   ``SEQUENCE`` tokens for this, none left out. The states start from a short
   Baum-Welch on a bounded sample (``SEED_CHUNKS`` chunks, ``SEED_SEQUENCES``
   sequences of each); every count that scores is from the whole corpus.
4. Scores: the words of each chunk that aren't frequent get their counts by a
   join, and the scaled forward recursion gives the exact likelihood of every
   whole text. A long text is cut into spans whose transfer matrices are
   multiplied in order, which is the same recursion.

A state's emission is mixed with the unigram distribution (share ``MIX``), and
a word without a training count has the unigram probability of an unknown word
in every state.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, remainder, small_batches, text_rows

STATES, PASSES = 8, 3
FREQUENT, BUCKETS = 2e-5, 4096
CHUNK_TOKENS, BLOCK_TOKENS, SEQUENCE, SPAN, DIRECT = 2_000_000, 300_000, 256, 512, 2048
SEED_CHUNKS, SEED_SEQUENCES, SEED_PASSES = 8, 64, 25
MIX = 0.02


# ---- chunks -------------------------------------------------------------------


def word_number(word: bytes) -> int:
    """52 bits of a word's hash, and below them the class of words that aren't
    frequent that it belongs to: by its length and last two bytes."""
    tail = int.from_bytes(word[-2:], "little") * 40503 + min(len(word), 12) * 977
    return xxhash.xxh64_intdigest(word) & -BUCKETS | tail % BUCKETS


class _Numbers(dict):
    """Word -> its number in a chunk, by first occurrence."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _chunk_task(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    names, part = ["chunk", "ids", "held", "lengths", "vocab", "train", "low", "high"], TaskContext.get().partitionId()
    known, ids, held, parts, size, n = _Numbers({b"": 0}), [], [], [], 0, 0

    def flush() -> pa.RecordBatch:
        lengths = np.array([len(p) for p in parts], np.int32)
        tokens = np.concatenate(parts)
        learn = np.repeat(~np.array(held, bool), lengths)
        train = np.bincount(tokens[learn], minlength=len(known)).astype(np.int32)
        vocab = np.array([word_number(w) for w in known], np.uint64)
        row = [[part << 32 | n], [ids], [held], [lengths.tolist()]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32())]
        cols = [pa.array(v, t) for v, t in zip(row, kinds)]
        # the high bits of tokens are mostly zero, and so they are kept apart
        cols += [pa.array([x.tobytes()]) for x in (vocab, train, tokens.astype(np.uint16), (tokens >> 16).astype(np.uint16))]
        return pa.record_batch(cols, names)

    for i, out, data in text_rows(batches, "id", "held", "data"):
        words = data.lower().split() if data else []
        words.append(b"")  # the end
        ids.append(i)
        held.append(out)
        parts.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
        size += len(words)
        if size > most:
            yield flush()
            n += 1
            known, ids, held, parts, size = _Numbers({b"": 0}), [], [], [], 0
    if ids:
        yield flush()


_CHUNK = "chunk long, ids array<long>, held array<boolean>, lengths array<int>, vocab binary, train binary, low binary, high binary"


_CLASSED = ["chunk", "ids", "held", "lengths", "low", "high", "classes"]


def _array(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(data, kind)


def _tokens(row: dict) -> np.ndarray:
    return _array(row["low"], np.uint16) | _array(row["high"], np.uint16).astype(np.int32) << 16


class Chunk:
    def __init__(self, row: dict):
        self.id, self.ids, self.held = row["chunk"], row["ids"], np.array(row["held"], bool)
        self.lengths = np.array(row["lengths"], np.int64)
        self.tokens = _tokens(row)
        self.vocab, self.train = _array(row["vocab"], np.uint64), _array(row["train"], np.int32)

    def classes(self, frequent: np.ndarray) -> np.ndarray:
        """The class of each word of the vocabulary."""
        rare = len(frequent) + (self.vocab & np.uint64(BUCKETS - 1)).astype(np.int64)
        if not len(frequent):
            return rare
        at = np.minimum(np.searchsorted(frequent, self.vocab), len(frequent) - 1)
        return np.where(frequent[at] == self.vocab, at, rare)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk(batch.slice(i, 1).to_pylist()[0])


def _vocab_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in _chunks(batches):
        on = c.train > 0
        yield pa.record_batch([pa.array(c.vocab[on].view(np.int64)), pa.array(c.train[on])], ["word", "n"])


def _rare_task(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    for c in _chunks(batches):
        at = np.flatnonzero(c.classes(frequent) >= len(frequent))
        cols = [c.vocab[at].view(np.int64), np.full(len(at), c.id), at.astype(np.int32)]
        yield pa.record_batch([pa.array(x) for x in cols], ["word", "chunk", "at"])


def _class_task(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Chunks with the classes of their words in place of the words."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            own = Chunk(row.to_pylist()[0]).classes(frequent).astype(np.int32).tobytes()
            yield pa.record_batch([row.column(row.schema.get_field_index(c)) if c != "classes" else pa.array([own]) for c in _CLASSED], _CLASSED)


# ---- the model ----------------------------------------------------------------


class Model:
    """``emit`` (classes, states), ``move`` (states, states), ``begin``. It is
    sent to tasks as ``arrays()``: a broadcast pickles classes by reference,
    and executors needn't have this module."""

    def __init__(self, emit: np.ndarray, move: np.ndarray, begin: np.ndarray):
        self.emit, self.move, self.begin = emit, move, begin

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.emit, self.move, self.begin

    @staticmethod
    def learn(counts: np.ndarray, moves: np.ndarray, begins: np.ndarray, prior: np.ndarray) -> Model:
        """From expected counts; ``prior`` is the classes' unigram distribution."""
        k = counts.shape[1]
        total = counts.sum(axis=0)
        share = np.where(total > 0, counts / np.where(total > 0, total, 1), prior[:, None])
        move = moves + 0.1
        return Model((1 - MIX) * share + MIX * prior[:, None], move / move.sum(axis=1, keepdims=True), (begins + 0.1) / (begins + 0.1).sum())

    @staticmethod
    def noise(prior: np.ndarray, k: int, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        counts = prior[:, None] * rng.gamma(1.0, 1.0, (len(prior), k))
        return Model.learn(counts, np.ones((k, k)) + 8 * np.eye(k), np.ones(k), prior)


def sequences(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and document of the pieces of at most ``size`` tokens."""
    n = -(-lengths // size)
    doc = np.repeat(np.arange(len(lengths)), n)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = (np.cumsum(lengths) - lengths)[doc] + nth * size
    return start, np.minimum(size, lengths[doc] - nth * size), doc


def blocks(lengths: np.ndarray, most: int = BLOCK_TOKENS) -> list[tuple[int, int]]:
    """Ranges of sequences or texts with about ``most`` tokens."""
    which = (np.cumsum(lengths) - lengths) // most
    cut = np.flatnonzero(np.r_[True, which[1:] != which[:-1], True]) if len(lengths) else []
    return list(zip(cut[:-1], cut[1:]))


def expected(symbols: np.ndarray, start: np.ndarray, length: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts of (class, state), of (state, state) and of first
    states over sequences, and their log likelihood: scaled forward and
    backward recursions, all sequences in step, the longest first."""
    by = np.argsort(-length, kind="stable")
    start, length = start[by], length[by]
    steps, k = int(length[0]), len(model.begin)
    on = np.searchsorted(-length, -np.arange(steps), side="left")  # sequences longer than t
    emit, move, back = model.emit, model.move, np.ascontiguousarray(model.move.T)
    alpha, seen, scale = [], [], []
    a, log = None, 0.0
    for t in range(steps):
        m = on[t]
        s = symbols[start[:m] + t]
        b = emit[s]
        a = (model.begin if a is None else a[:m] @ move) * b
        c = a.sum(axis=1)
        a /= c[:, None]
        alpha.append(a)
        seen.append((s, b))
        scale.append(c)
        log += np.log(c).sum()
    counts = np.zeros((len(emit), k))
    moves = np.zeros((k, k))
    gammas: list = [None] * steps
    beta = np.ones((0, k))
    for t in range(steps - 1, -1, -1):
        if t + 1 < steps:
            # what comes after t, for sequences that go on; others end here
            ahead = seen[t + 1][1] * beta / scale[t + 1][:, None]
            moves += alpha[t][: on[t + 1]].T @ ahead
            now = np.ones((on[t], k))
            now[: on[t + 1]] = ahead @ back
            beta = now
        else:
            beta = np.ones((on[t], k))
        gammas[t] = alpha[t] * beta
    flat, every = np.concatenate([s for s, _ in seen]), np.concatenate(gammas)
    for j in range(k):
        counts[:, j] = np.bincount(flat, weights=every[:, j], minlength=len(emit))
    return counts, moves * move, gammas[0].sum(axis=0), log


def forward(symbols: np.ndarray, extra: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """Natural log likelihood of documents that lie one behind another;
    ``extra`` is the log share of each token in its class."""
    starts = np.cumsum(lengths) - lengths
    sums = np.concatenate([[0.0], np.cumsum(extra)])
    out = sums[starts + lengths] - sums[starts]
    k = len(model.begin)
    short = np.flatnonzero(lengths <= DIRECT)
    if len(short):
        out[short] += _in_step(symbols, starts[short], lengths[short], np.tile(model.begin, (len(short), 1)), model, first=True)[0]
    long_ = np.flatnonzero(lengths > DIRECT)
    for d in long_:
        # The first span from the beginning, the others from each state; then one after another.
        at, size, _ = sequences(lengths[d : d + 1], SPAN)
        at = at + starts[d]
        log, a = _in_step(symbols, at[:1], size[:1], model.begin[None], model, first=True)
        total, a = log[0], a[0]
        n = len(at) - 1
        logs, rows = _in_step(symbols, np.repeat(at[1:], k), np.repeat(size[1:], k), np.tile(np.eye(k), (n, 1)), model, first=False)
        logs, rows = logs.reshape(n, k), rows.reshape(n, k, k)
        for log, row in zip(logs, rows):
            top = log.max()
            a = (a * np.exp(log - top)) @ row
            c = a.sum()
            total += top + np.log(c)
            a /= c
        out[d] += total
    return out


def _in_step(symbols: np.ndarray, start: np.ndarray, length: np.ndarray, a: np.ndarray, model: Model, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward recursion from the state distributions ``a``: log scales
    and last distributions."""
    by = np.argsort(-length, kind="stable")
    start, size, a = start[by], length[by], a[by].copy()
    log, last = np.zeros(len(by)), np.empty_like(a)
    on = np.searchsorted(-size, -np.arange(size[0] + 1), side="left")
    for t in range(int(size[0])):
        m = on[t]
        b = model.emit[symbols[start[:m] + t]]
        a = a[:m] * b if first and t == 0 else (a[:m] @ model.move) * b
        c = a.sum(axis=1)
        a /= c[:, None]
        log[:m] += np.log(c)
        last[on[t + 1] : m] = a[on[t + 1] :]
    back = np.argsort(by, kind="stable")
    return log[back], last[back]


# ---- passes over the corpus ---------------------------------------------------


def _learners(c: Chunk, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the training documents' tokens, and their sequences."""
    learn = ~c.held
    tokens = c.tokens[np.repeat(learn, c.lengths)]
    start, size, _ = sequences(c.lengths[learn], SEQUENCE)
    return c.classes(frequent)[tokens], start, size


def _pass_task(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, model) -> Iterator[pa.RecordBatch]:
    """One row for each class, state and for the first states: what this
    task's sequences are expected to count."""
    m = Model(*model.value)
    k, counts, moves, begins, log = len(m.begin), None, None, None, 0.0
    for c in _chunks(batches):
        symbols, start, size = _learners(c, frequent)
        for a, b in blocks(size):
            got = expected(symbols, start[a:b], size[a:b], m)
            counts, moves, begins = got[:3] if counts is None else (counts + got[0], moves + got[1], begins + got[2])
    if counts is not None:
        row = np.concatenate([np.arange(len(counts)), -2 - np.arange(k), [-1]])
        table = np.concatenate([counts, moves, begins[None]])
        use = table.any(axis=1)
        yield pa.record_batch([pa.array(row[use], pa.int64()), *(pa.array(table[use, j]) for j in range(k))], ["row", *(f"n{j}" for j in range(k))])


def _seed_task(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    for c in _chunks(batches):
        symbols, start, size = _learners(c, frequent)
        some = np.unique(np.linspace(0, len(size) - 1, min(most, len(size))).astype(int)) if len(size) else []
        rows = [symbols[start[i] : start[i] + size[i]].astype(np.int32).tobytes() for i in some]
        yield pa.record_batch([pa.array(rows, pa.binary())], ["symbols"])


def _score(ids: list, held: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, classes: np.ndarray, counts: np.ndarray, model: Model, mass: np.ndarray, total: float) -> pd.DataFrame:
    """Scores of a chunk's documents; ``counts`` is of its vocabulary, and
    ``total`` is N + 0.5 (V + 1)."""
    known = counts > 0
    base = np.log((counts + 0.5) / total)
    # An unknown word is a class of its own, the last one.
    share = np.where(known, np.log((counts + 0.5) / np.where(known, mass[classes], 1)) + np.log1p(-0.5 / total), 0.0)
    classes = np.where(known, classes, len(mass))
    ends, out, ten = np.cumsum(lengths), [], np.log(10.0)
    for a, b in blocks(lengths):
        own = tokens[ends[a] - lengths[a] : ends[b - 1]]
        size = lengths[a:b]
        stop = np.cumsum(size)
        sums = np.concatenate([[0.0], np.cumsum(base[own])])
        knows = np.concatenate([[0], np.cumsum(known[own])])
        log = forward(classes[own], share[own], size, model)
        out.append((knows[stop] - knows[stop - size], (sums[stop] - sums[stop - size]) / ten, log / ten))
    n_known, base_score, score = (np.concatenate(x) for x in zip(*out))
    return pd.DataFrame({"id": pd.array(ids, dtype="Int64"), "held_out": held, "n_tokens": lengths, "n_known": n_known, "base_score": base_score, "score": score})


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, passes: int = PASSES) -> DataFrame:
    """``(id_col, held_out, n_tokens, n_known, train_tokens, base_score,
    score)``, one row for each row; scores are log10 probabilities.

    Held out are ids whose crc32 modulo 5 is 1; a null id isn't. Rows with
    equal ids are documents of their own, each counted; other columns of
    ``docs`` are left out. A null or blank text is its end token. Without any training text every token is
    unknown and has the base probability 1."""
    spark = docs.sparkSession
    small_batches(spark)
    held = F.coalesce(remainder(id_col) == 1, F.lit(False))
    src = docs.select(F.col(id_col).cast("long").alias("id"), held.alias("held"), F.col(text_col).cast("binary").alias("data"))
    chunks = materialize(src.mapInArrow(partial(_chunk_task, most=CHUNK_TOKENS), _CHUNK), "chunks")
    words = chunks.select("chunk", "ids", "held", "lengths", "vocab", "train", F.lit(b"").alias("low"), F.lit(b"").alias("high")).mapInArrow(_vocab_task, "word long, n int").groupBy("word").agg(F.sum("n").alias("c"))
    words = materialize(words, "words")
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total = n + 0.5 * (v + 1)
    least = max(FREQUENT * n, 1)
    top = words.filter(F.col("c") >= least).select("word", "c").toPandas()  # at most 1 / FREQUENT rows
    order = np.argsort(top["word"].to_numpy(np.int64).view(np.uint64)) if len(top) else np.zeros(0, int)
    frequent = top["word"].to_numpy(np.int64).view(np.uint64)[order]
    mass = np.zeros(len(frequent) + BUCKETS)
    mass[: len(frequent)] = top["c"].to_numpy(float)[order] + 0.5 if len(top) else []
    for b, m in words.filter(F.col("c") < least).groupBy(F.col("word").bitwiseAND(F.lit(BUCKETS - 1)).alias("bucket")).agg(F.sum(F.col("c") + 0.5)).collect():  # BUCKETS rows
        mass[len(frequent) + b] = m
    prior = mass / mass.sum() if n else np.full(len(mass), 1 / len(mass))

    model = Model.noise(prior, states)
    if n:
        some = chunks.join(F.broadcast(chunks.select("chunk").orderBy(F.xxhash64("chunk")).limit(SEED_CHUNKS)), "chunk", "left_semi").select(*chunks.columns)
        rows = some.mapInArrow(partial(_seed_task, frequent=frequent, most=SEED_SEQUENCES), "symbols binary").collect()
        seqs = sorted((np.frombuffer(r[0], np.int32) for r in rows), key=lambda s: (len(s), s.tobytes()))
        if seqs:
            size = np.array([len(s) for s in seqs])
            flat, start = np.concatenate(seqs).astype(np.int64), np.cumsum(size) - size
            for _ in range(SEED_PASSES):
                model = Model.learn(*expected(flat, start, size, model)[:3], prior)
    columns = [f"n{j}" for j in range(states)]
    for _ in range(passes if n else 0):
        sent = spark.sparkContext.broadcast(model.arrays())  # classes x states, bounded by FREQUENT and BUCKETS
        kind = "row long, " + ", ".join(f"{c} double" for c in columns)
        got = chunks.mapInArrow(partial(_pass_task, frequent=frequent, model=sent), kind).groupBy("row").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
        table, row = got[columns].to_numpy(float), got["row"].to_numpy(np.int64)
        counts, moves, begins = np.zeros((len(prior), states)), np.zeros((states, states)), np.zeros(states)
        counts[row[row >= 0]] = table[row >= 0]
        moves[-2 - row[row < -1]] = table[row < -1]
        begins[:] = table[row == -1].sum(axis=0)
        model = Model.learn(counts, moves, begins, prior)

    # The last class is the unknown word, as likely in every state.
    model.emit = np.concatenate([model.emit, np.full((1, states), 0.5 / total)])
    rare = chunks.mapInArrow(partial(_rare_task, frequent=frequent), "word long, chunk long, at int").join(words, "word").select("chunk", "at", "c")
    sent = spark.sparkContext.broadcast((model.arrays(), mass[: len(frequent)] - 0.5, mass, total))

    def score(chunk: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        arrays, known, mass, total = sent.value
        model = Model(*arrays)
        out = []
        for row in chunk.to_dict("records"):
            classes = _array(row["classes"], np.int32).astype(np.int64)
            often, counts = classes < len(known), np.zeros(len(classes))
            counts[often] = known[classes[often]]
            counts[own["at"].to_numpy()] = own["c"].to_numpy()
            out.append(_score(row["ids"], np.array(row["held"], bool), np.array(row["lengths"], np.int64), _tokens(row), classes, counts, model, mass, total))
        return pd.concat(out) if out else pd.DataFrame(columns=["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    kind = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    classed = chunks.mapInArrow(partial(_class_task, frequent=frequent), "chunk long, ids array<long>, held array<boolean>, lengths array<int>, low binary, high binary, classes binary")
    out = classed.groupBy("chunk").cogroup(rare.groupBy("chunk")).applyInPandas(score, kind)
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"), "base_score", "score")
