"""Document fingerprints by randomised edit embedding.

A walk reads a text: at step j it stands on a character, notes it, and moves
on if a random bit shared by all texts, drawn for (j, character), is set. Two
texts that differ by an edit meet again after a few steps and note the same
from then on, so a small edit distance becomes a small Hamming distance
between what the walks note (a text of n characters takes about 2n steps).

The fingerprint samples that sequence at steps shared by all texts: all of
the first 64, then 64 of each octave [64, 128), [128, 256) and so on, each as
four random bits of the character (1 to 15; 0: past the end). It grows with
the logarithm of the length, and texts of any two lengths compare octave by
octave. Their likeness is the share of the longer walk's steps on which they
agree, each octave weighing as many steps as it stands for.

Near-duplicates: band keys from a few sampled bits each bring texts together,
and their fingerprints verify the pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, partitions, small_batches, text_rows
from .components import components

SEED = 20_240_229
SAMPLES = 64  # of an octave
PERIOD = 4093  # steps after which the walk's random bits come again
BATCH_CHARS = 8_000_000
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


class Walk:
    """The shared randomness: moves, sampled steps and the bits of samples."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.moves = rng.integers(0, 2, (PERIOD, 256)).astype(np.intp)
        self.moves[:, 0] = 0  # class 0 is the end of a text; the walk stays there
        self.codes = rng.integers(1, 16, (SAMPLES, 256)).astype(np.uint8)
        self.codes[:, 0] = 0
        self.seed = seed

    def steps(self, octave: int) -> np.ndarray:
        """The sampled steps of an octave, ascending."""
        if octave == 0:
            return np.arange(SAMPLES)
        low = SAMPLES << (octave - 1)
        rng = np.random.default_rng([self.seed, octave])
        return np.sort(low + rng.choice(low, SAMPLES, replace=False))


def classes(text: str) -> np.ndarray:
    """A class from 1 to 255 for each code point, and 0 at the end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(len(points) + 1, np.uint8)
    np.maximum((points * np.uint32(2654435761)) >> np.uint32(24), 1, out=out[:-1], casting="unsafe")
    return out


def embed(texts: list[str], walk: Walk) -> list[np.ndarray]:
    """For each octave, (texts, 64) samples. All walks go in step; those that
    have ended drop out."""
    if not texts:
        return []
    parts = [classes(t) for t in texts]
    flat = np.concatenate(parts)
    size = np.array([len(p) for p in parts])
    del parts
    place = np.cumsum(size) - size
    row = np.arange(len(texts))
    octaves, octave = [], 0
    while len(row):
        steps = walk.steps(octave)
        samples = np.zeros((len(texts), SAMPLES), np.uint8)
        step = 0 if octave == 0 else SAMPLES << (octave - 1)
        stop = SAMPLES << octave
        seen = np.empty(len(row), np.uint8)
        move = np.empty(len(row), np.intp)
        wanted = dict(zip(steps.tolist(), range(SAMPLES)))
        take, moves, add = np.take, walk.moves, np.add
        while step < stop:
            take(flat, place, out=seen, mode="clip")
            if step in wanted:
                j = wanted[step]
                samples[row, j] = walk.codes[j][seen]
            take(moves[step % PERIOD], seen, out=move, mode="clip")
            add(place, move, out=place)
            step += 1
            if not step & 255:
                on = flat[place] != 0
                if not on.all():
                    row, place = row[on], place[on]
                    if not len(row):
                        break
                    seen, move = np.empty(len(row), np.uint8), np.empty(len(row), np.intp)
        on = flat[place] != 0
        row, place = row[on], place[on]
        octaves.append(samples)
        octave += 1
    return octaves


def prints(octaves: list[np.ndarray], n: int) -> list[str]:
    """Hexadecimal strings without octaves past a text's end; equal texts have
    equal strings, an empty text the empty string."""
    if not octaves:
        return [""] * n
    chars = _HEX[np.concatenate(octaves, axis=1)]
    ends = np.max([np.where(o.any(axis=1), (i + 1) * SAMPLES, 0) for i, o in enumerate(octaves)], axis=0)
    return [chars[i, : ends[i]].tobytes().decode() for i in range(n)]


def likeness(octaves: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows a with rows b: 0 to 1, 1 for two empty texts."""
    same, all_ = np.zeros(len(a)), np.zeros(len(a))
    for o, x in enumerate(octaves):
        weight = 1 << max(o - 1, 0)
        u, v = x[a], x[b]
        same += weight * ((u == v) & (u > 0)).sum(axis=1)
        all_ += weight * ((u | v) > 0).sum(axis=1)
    return np.where(all_ > 0, same / np.maximum(all_, 1), 1.0)


def parse_prints(values: list[str]) -> list[np.ndarray]:
    """The octaves back from hexadecimal strings."""
    n = max([len(v) // SAMPLES for v in values], default=0)
    out = [np.zeros((len(values), SAMPLES), np.uint8) for _ in range(n)]
    table = np.zeros(256, np.uint8)
    table[_HEX] = np.arange(16)
    for i, v in enumerate(values):
        nibbles = table[np.frombuffer(v.encode(), np.uint8)].reshape(-1, SAMPLES)
        for o, x in enumerate(nibbles):
            out[o][i] = x
    return out


# ---- every text and its edited text ------------------------------------------


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the next one's start."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pair_task(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Rows come in order; one that only ends the partition is marked ``halo``."""
    walk = Walk(seed)
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def flush(ids: list, texts: list[str]) -> pa.RecordBatch:
        n = len(texts) - 1
        changed = [edited(texts[i], texts[i + 1]) for i in range(n)]
        octaves = embed(texts + changed, walk)
        own, at = prints(octaves, 2 * n + 1), np.arange(n)
        sha = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed]
        cols = [pa.array(ids[:n], pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()), pa.array(sha), pa.array(own[:n]), pa.array(own[n + 1 :])]
        cols += [pa.array(likeness(octaves, at, at + n + 1)), pa.array(likeness(octaves, at, at + 1))]
        return pa.record_batch(cols, names)

    ids, texts, held = [], [], 0
    for i, text, halo in text_rows(batches, "id", "text", "halo"):
        ids.append(i)
        texts.append(text or "")
        held += len(texts[-1])
        if halo:
            break
        if held > BATCH_CHARS and len(texts) > 1:
            yield flush(ids, texts)
            ids, texts, held = ids[-1:], texts[-1:], len(texts[-1])
    for _ in batches:
        pass
    if len(texts) > 1:
        yield flush(ids, texts)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text, halo)`` in ranges of ids, a partition each, sorted; each
    range ends with a copy (``halo``) of the row that follows its last, the
    last range with the very first row. The texts are shuffled once. Null ids
    come first; rows with one id are ordered by text."""
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    n = partitions(spark)
    at = F.percentile_approx("id", F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5)), F.lit(100 * n))
    cut, low, nulls = src.agg(at, F.min("id"), F.count(F.when(F.col("id").isNull(), 1))).first()
    cuts = np.unique(np.array([c for c in cut or [] if c is not None and c != low], np.int64))
    first = None if nulls else low
    last = len(cuts)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ranges(ids: pd.Series) -> pd.Series:
        null = ids.isna().to_numpy()
        value = ids.fillna(0).astype("int64").to_numpy()
        own = np.where(null, 0, np.searchsorted(cuts, value, side="right"))
        opens = (own > 0) & ~null & np.isin(value, cuts)
        begins = null if first is None else ~null & (value == first)
        return pd.Series([[o] + ([o - 1] if p else []) + ([last] if b else []) for o, p, b in zip(own.tolist(), opens, begins)])

    dealt = src.select("*", F.posexplode(ranges("id")).alias("copy", "range")).withColumn("halo", F.col("copy") > 0)
    dealt = dealt.repartitionById(last + 1, F.col("range"))
    order = [F.col("halo").asc(), F.col("id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    return dealt.sortWithinPartitions(*order).select("id", "text", "halo")


def edit_prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """One row for each row: its id, length, fingerprint, that of its edited
    text, and the likeness to that and to the next document's.

    The next document is that of the next larger id; the last is followed by
    the first, a lone one by itself. A null text is empty; the empty text's
    fingerprint is the empty string, and two empty texts have likeness 1."""
    kind = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    out = with_next(docs, id_col, text_col).mapInArrow(partial(_pair_task, seed=seed), kind)
    return out.withColumnRenamed("id", id_col)


# ---- fingerprints and near-duplicates ----------------------------------------


def _print_task(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    walk = Walk(seed)
    ids, texts, held = [], [], 0

    def flush() -> pa.RecordBatch:
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(prints(embed(texts, walk), len(texts)))], ["id", "fingerprint"])

    for i, text in text_rows(batches, "id", "text"):
        ids.append(i)
        texts.append(text or "")
        held += len(texts[-1])
        if held > BATCH_CHARS:
            yield flush()
            ids, texts, held = [], [], 0
    if ids:
        yield flush()


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """``(id_col, fingerprint)`` of every row; a null text counts as empty."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(partial(_print_task, seed=seed), "id long, fingerprint string").withColumnRenamed("id", id_col)


def _band_task(batches: Iterator[pa.RecordBatch], bands: int, width: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Keys from ``width`` sampled symbols each. Steps are drawn as the walk
    weighs them, from each of the two longest octaves a text may share with a
    slightly longer or shorter one."""
    import xxhash

    for rep, fingerprint in text_rows(batches, "rep", "fingerprint"):
        top = len(fingerprint) // SAMPLES
        keys = set()
        for end in {top, top - 1} - {0, -1}:
            rng = np.random.default_rng([seed, end])
            weight = np.repeat([1 << max(o - 1, 0) for o in range(end)], SAMPLES).astype(float)
            weight[(end - 1) * SAMPLES :] /= 4 if end > 1 else 1  # the walk may end early in it
            for b in range(bands):
                at = rng.choice(end * SAMPLES, width, replace=False, p=weight / weight.sum())
                keys.add(xxhash.xxh64_intdigest("".join(fingerprint[i] for i in at) + f"/{end}/{b}", seed) - (1 << 63))
        keys = sorted(keys) or [0]
        yield pa.record_batch([pa.array(keys), pa.array([rep] * len(keys)), pa.array([fingerprint] * len(keys))], ["key", "rep", "fingerprint"])


def _verify_task(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key and part; the links of a key as a star for each
    of its components, found by asking each fingerprint once."""

    def stars(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        octaves = parse_prints([r[2] for r in rows])
        todo, at = np.ones(len(rows), bool), np.arange(len(rows))
        for seed in at:
            if not todo[seed]:
                continue
            todo[seed], front, found = False, [seed], []
            while front:
                ask, left = front.pop(), at[todo]
                new = left[likeness(octaves, np.full(len(left), ask), left) >= least]
                todo[new] = False
                front += new.tolist()
                found += new.tolist()
            if found:
                yield pa.record_batch([pa.array([rows[i][1] for i in found], pa.int64()), pa.array([rows[seed][1]] * len(found), pa.int64())], ["a", "b"])

    held, last = [], None
    for key, pa_, pb, rep, fingerprint in text_rows(batches, "key", "pa", "pb", "rep", "fingerprint"):
        if (key, pa_, pb) != last and held:
            if len(held) > 1:
                yield from stars(held)
            held = []
        last = (key, pa_, pb)
        held.append((key, rep, fingerprint))
    if len(held) > 1:
        yield from stars(held)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8, bands: int = 20, width: int = 6, key_rows: int = 4000, seed: int = SEED) -> DataFrame:
    """``(id_col, component_id)``: documents whose fingerprints share a band
    and have a likeness of ``least`` or more are linked; the component is the
    smallest id reachable. Copies are one fingerprint; a band with more than
    ``key_rows`` fingerprints is compared in pairs of parts. Null texts are
    empty and alike; rows without an id get a null component."""
    own = materialize(edit_fingerprints(docs, id_col, text_col, seed), "editprints")
    reps = materialize(own.groupBy("fingerprint").agg(F.min(id_col).alias("rep")).filter("rep is not null"), "reps")
    keyed = reps.mapInArrow(partial(_band_task, bands=bands, width=width, seed=seed), "key long, rep long, fingerprint string")
    hot = keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    dealt = keyed.join(hot, "key").withColumn("parts", F.when(F.col("n") > key_rows, F.ceil(F.col("n") / (key_rows // 2))).otherwise(1).cast("int"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.filter((F.col("parts") == 1) | (F.col("part") != F.col("other")))
    by = ["key", "pa", "pb"]
    dealt = dealt.select("key", F.least("part", "other").alias("pa"), F.greatest("part", "other").alias("pb"), "rep", "fingerprint")
    dealt = dealt.repartition(partitions(docs.sparkSession), *by).sortWithinPartitions(*by)
    roots = components(dealt.mapInArrow(partial(_verify_task, least=least), "a long, b long"))
    known = reps.join(roots, reps["rep"] == roots["node"], "left").select("fingerprint", F.coalesce("component", "rep").alias("component_id"))
    return own.join(known, "fingerprint", "left").select(id_col, F.when(F.col(id_col).isNotNull(), F.col("component_id")).alias("component_id"))
