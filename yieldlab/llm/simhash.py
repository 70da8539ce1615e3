"""SimHash near-dedup by bit-sliced comparison.

A document's fingerprint has a bit set if more than half of the XXH64 hashes
of its word shingles have it. Fingerprints that differ in at most
``max_bits`` bits link. The 64 bits are cut into ``max_bits + 2`` blocks: a
linked pair differs in at most ``max_bits`` of them, so it agrees on at least
two, and every pair of blocks makes a table whose key is their bits. Rows of
one key are compared in bit slices: 64 bit planes hold one bit of 64
fingerprints a word, a query flips a plane where its own bit is set and adds
it to carry-save counters, and words whose 64 fingerprints have all passed
the radius are abandoned. A key leaves only a star of links to the smallest
of each of its components, never its pairs. Copies share one fingerprint and
are joined to it at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions, small_batches, text_rows
from .components import components

SHINGLE, MAX_BITS = 3, 3
#: Rows of one key that are compared in one task; larger keys are dealt out in pairs of parts.
KEY_ROWS = 20_000
SMALL = 96  # groups below this are compared together


def shingle_hashes(data: bytes, k: int = SHINGLE) -> list[int]:
    """XXH64 (seed 42) of the k-word shingles of a text in UTF-8, A-Z lowered,
    words split at ASCII white space; of the whole sequence if it's shorter."""
    words, h = data.lower().split(), xxhash.xxh64_intdigest
    if len(words) < k:
        return [h(b" ".join(words), 42)] if words else []
    return [h(b" ".join(s), 42) for s in zip(*(words[i:] for i in range(k)))]


def majority(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One fingerprint for each run of ``lengths`` hashes (0: fingerprint 0)."""
    out, full = np.zeros(len(lengths), np.uint64), lengths > 0
    if full.any():
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(lengths) - lengths)[full]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        high = (2 * ones > lengths[full][:, None]).astype(np.uint8)
        out[full] = np.packbits(high, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _fingerprint_task(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    ids, hashes, lengths, held = [], [], [], 0

    def flush() -> pa.RecordBatch:
        flat = np.concatenate([np.asarray(h, np.uint64) for h in hashes])
        prints = majority(flat, np.array(lengths, np.int64)).view(np.int64)
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(prints)], ["id", "simhash"])

    for i, data in text_rows(batches, "id", "data"):
        ids.append(i)
        hashes.append(shingle_hashes(data or b"", k))
        lengths.append(len(hashes[-1]))
        held += lengths[-1]
        if held > 200_000 or len(ids) > 20_000:
            yield flush()
            ids, hashes, lengths, held = [], [], [], 0
    if ids:
        yield flush()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, simhash long)`` for every row."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("data"))
    return src.mapInArrow(partial(_fingerprint_task, k=shingle), "id long, simhash long")


# ---- comparison ---------------------------------------------------------------


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """(64, words): bit b of fingerprint i is bit i % 64 of word i // 64 of
    plane b. Padding repeats the last fingerprint."""
    pad = np.concatenate([prints, np.repeat(prints[-1:], -len(prints) % 64)])
    bits = np.unpackbits(pad.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def within(planes: np.ndarray, flips: np.ndarray | None, radius: int) -> np.ndarray:
    """Bits of the fingerprints that differ in at most ``radius`` bits.

    ``planes`` is (64, words). With ``flips`` (queries, 64), each 0 or all
    ones, the result is (queries, words); without, the planes hold
    differences already and the result is (words,)."""
    levels = radius.bit_length()
    shape = (1 if flips is None else len(flips), planes.shape[1])
    alive = np.arange(shape[0] * shape[1])
    query, word = np.divmod(alive, shape[1])
    # Counters start so that passing the radius carries out of the top level.
    start = (1 << levels) - 1 - radius
    count = [np.full(len(alive), ~np.uint64(0) if start >> j & 1 else np.uint64(0)) for j in range(levels)]
    over, out = np.zeros(len(alive), np.uint64), np.zeros(shape[0] * shape[1], np.uint64)
    for b in range(64):
        carry = planes[b][word] if flips is None else planes[b][word] ^ flips[query, b]
        for c in count:
            c_and = c & carry
            np.bitwise_xor(c, carry, out=c)
            carry = c_and
        over |= carry
        if b % 8 == 7:
            open_ = over != ~np.uint64(0)
            if not open_.all():  # these words of 64 are all past the radius
                alive, query, word, over = alive[open_], query[open_], word[open_], over[open_]
                count = [c[open_] for c in count]
                if not len(alive):
                    break
    out[alive] = ~over
    return out[0 : shape[1]] if flips is None else out.reshape(shape)


def _members(bits: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.ascontiguousarray(bits).view(np.uint8), bitorder="little")[:n])


def group_labels(prints: np.ndarray, radius: int) -> np.ndarray:
    """Smallest index reachable by links, for every fingerprint of a group: a
    search that asks every fingerprint once, in blocks of queries."""
    n = len(prints)
    planes, label = bit_planes(prints), np.arange(n)
    bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    flips = np.where(bits == 1, ~np.uint64(0), np.uint64(0))
    todo = np.zeros(planes.shape[1], np.uint64)
    todo.view(np.uint8)[:] = np.packbits(np.arange(planes.shape[1] * 64) < n, bitorder="little")
    step = max(1, min(256, (1 << 21) // planes.shape[1]))
    for seed in range(n):
        if not int(todo[seed >> 6]) >> (seed & 63) & 1:
            continue
        front = [np.array([seed])]
        todo[seed >> 6] &= ~(np.uint64(1) << np.uint64(seed & 63))
        while front:
            ask = np.concatenate(front)
            ask, rest = ask[:step], ask[step:]
            front = [rest] if len(rest) else []
            found = np.bitwise_or.reduce(within(planes, flips[ask], radius), axis=0) & todo
            todo &= ~found
            new = _members(found, n)
            label[new] = seed
            if len(new):
                front.append(new)
    return label


def _small_links(prints: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows of many small groups that lie one behind another:
    rows at distance 1, 2, ... of one group, their differences in bit planes."""
    left, right = [], []
    at = np.arange(len(prints))
    for lag in range(1, len(prints)):
        at = at[at + lag < len(prints)]
        at = at[group[at] == group[at + lag]]
        if not len(at):
            break
        for part in np.array_split(at, len(at) // 500_000 + 1):
            hit = _members(within(bit_planes(prints[part] ^ prints[part + lag]), None, radius), len(part))
            left.append(part[hit])
            right.append(part[hit] + lag)
    if not left:
        return at[:0], at[:0]
    return np.concatenate(left), np.concatenate(right)


def _least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            break
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
    return label


def _link_task(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key, part_a, part_b; a star of links for each."""

    def stars(keys: np.ndarray, prints: np.ndarray, reps: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        size = np.diff(np.r_[starts, len(keys)])
        group = np.repeat(np.arange(len(starts)), size)
        few = np.flatnonzero(np.repeat((size > 1) & (size < SMALL), size))
        label = np.arange(len(keys))
        if len(few):
            a, b = _small_links(prints[few], group[few], radius)
            label[few] = few[_least_labels(len(few), a, b)]
        for g in np.flatnonzero(size >= SMALL):
            s = slice(starts[g], starts[g] + size[g])
            label[s] = starts[g] + group_labels(prints[s], radius)
        far = np.flatnonzero(label != np.arange(len(keys)))
        if len(far):
            yield pa.record_batch([pa.array(reps[far]), pa.array(reps[label[far]])], ["a", "b"])

    held: list[pa.RecordBatch] = []

    def arrays(batch):
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        return np.stack(cols[:3], axis=1), cols[3].view(np.uint64), cols[4]

    # Only whole groups are handed on: the last group of what is held waits for the next batch.
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < 50_000:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        keys, prints, reps = arrays(whole)
        ends = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
        if len(ends):
            cut = ends[-1] + 1
            yield from stars(keys[:cut], prints[:cut], reps[:cut])
            held = [whole.slice(cut)]
        else:
            held = [whole]
    if held:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()
        if whole:
            yield from stars(*arrays(whole[0]))


def _keys(simhash: str, max_bits: int) -> Column:
    """One key for each pair of blocks, its number in the top bits."""
    n = max_bits + 2
    cuts = [round(i * 64 / n) for i in range(n + 1)]
    x, keys = F.col(simhash), []
    for t, (i, j) in enumerate(combinations(range(n), 2)):
        key = F.lit(t).cast("long")
        for b in (i, j):
            width = cuts[b + 1] - cuts[b]
            key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned(x, cuts[b]).bitwiseAND(F.lit((1 << width) - 1)))
        keys.append(key)
    return F.array(*keys)


def links(prints: DataFrame, max_bits: int = MAX_BITS, key_rows: int = KEY_ROWS) -> DataFrame:
    """``(a, b)``: enough linked pairs of ``rep`` to connect whatever links
    among distinct ``(simhash, rep)`` rows."""
    if max_bits < 1:
        raise ValueError("max_bits is at least 1")
    keyed = prints.select("simhash", "rep", F.explode(_keys("simhash", max_bits)).alias("key"))
    hot = keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > key_rows)
    parts = F.coalesce(F.ceil(F.col("n") / F.lit(key_rows // 2)), F.lit(1)).cast("int")
    dealt = keyed.join(hot, "key", "left").withColumn("parts", parts)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("simhash"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # Of a key in parts, each pair of parts is a task's work; a lone part is covered by its pairs.
    dealt = dealt.filter((F.col("parts") == 1) | (F.col("part") != F.col("other")))
    dealt = dealt.select("key", F.least("part", "other").cast("long").alias("pa"), F.greatest("part", "other").cast("long").alias("pb"), "simhash", "rep")
    by = ["key", "pa", "pb"]
    dealt = dealt.repartition(partitions(prints.sparkSession), *by).sortWithinPartitions(*by)
    return dealt.mapInArrow(partial(_link_task, radius=max_bits), "a long, b long")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, key_rows: int = KEY_ROWS) -> DataFrame:
    """``(id_col, simhash, fingerprint, component_id)``, one row for each row.

    A null or blank text has fingerprint zero and links like any other.
    ``component_id`` is the smallest id reachable; a null id is never the
    smallest, and where all ids are null the component is null. Rows that
    repeat an id each get a row. Other columns are ignored."""
    own = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash")
    reps = own.groupBy("simhash").agg(F.min("id").alias("rep"))
    distinct = materialize(reps, "prints")
    roots = components(links(distinct.filter("rep is not null"), max_bits, key_rows))
    known = distinct.join(roots, distinct["rep"] == roots["node"], "left").select("simhash", F.coalesce("component", "rep").alias("component_id"))
    return own.join(known, "simhash").select(
        F.col("id").alias(id_col), "simhash", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component (and all
    rows without an id, which can't be told apart)."""
    found = simhash_dedup(docs, id_col, text_col, **how)
    gone = found.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
