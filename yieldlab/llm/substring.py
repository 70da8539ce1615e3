"""Removal of repeated passages with an FM-index per shard.

A window is ``window`` consecutive words of one document. A word goes if a
window that covers it has a word sequence that also starts in a document with
a smaller id.

1. *Anchors.* The anchor of a window is its gram of ``gram`` words with the
   smallest hash (the first, if it comes twice). Equal windows have equal
   anchors at equal places, so windows with one anchor in common are one
   passage (at most ``2 * window - gram`` words) that goes to the shard of
   the anchor's hash. Only hashes leave the tasks here.
2. *Copies.* Passages are grouped by anchor and by the hash of their words.
   Anchors of one document only end here. Of equal passages one, that of the
   smallest id, stands for all.
3. *FM-index.* Where an anchor has different passages, their words are fetched
   and each shard gets an FM-index of its passages (suffix array by prefix
   doubling, Burrows-Wheeler transform in a wavelet matrix of packed bits).
   Every window of every passage is streamed against it: backward search
   from its last word on, all windows of the shard in step, ending early
   where the interval narrows to one suffix. The smallest id of the interval
   is the first document of the window.
4. A document with a larger id than its passage's smallest loses the whole
   passage, the smallest one the windows that the index found in a smaller
   document still.

An anchor with more than ``hot`` different passages isn't indexed in one
task: its windows are grouped by their 128-bit hashes over the whole cluster,
which gives the same answer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import HashCache, drop_table, materialize, partitions, small_batches, text_rows

WINDOW, GRAM = 50, 20
HOT = 20_000
SHARD_WORDS = 60_000
_B1, _B2 = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that leaves no structure of its input."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base & ((1 << 64) - 1), inverse):
        p = np.full(n, b, np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


class Rolling:
    """Hashes of any run of words of a flat array, from prefix sums."""

    def __init__(self, words: np.ndarray, base: int):
        up, self.down = powers(base, len(words) + 1)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[:-1], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.down[start])


def first_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Index of the first smallest of x[i : i + width] for every i."""
    at, low, have = np.arange(len(x)), x, 1
    while have < width:
        step = min(have, width - have)
        n = len(low) - step
        take = low[step:] < low[:n]
        at = np.where(take, at[step:], at[:n])
        low = np.where(take, low[step:], low[:n])
        have += step
    return at


def passages(words: np.ndarray, lengths: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """Passages of documents that lie one behind another: document number,
    first word in it, words before the anchor, windows, how often the passage
    follows itself a word on, and the hashes of anchor and passage."""
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    roll = Rolling(words, _B1)
    n = len(words) - gram + 1
    grams = roll.of(np.arange(n), np.arange(n) + gram)
    start = np.arange(len(words) - window + 1)
    anchor = first_minimum(grams, window - gram + 1)
    ok = start + window <= ends[doc[start]]
    start, anchor = start[ok], anchor[ok]
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)]) if len(start) else start
    count = np.diff(np.r_[new, len(start)])
    start, anchor = start[new], anchor[new]
    stop = start + count - 1 + window
    other = Rolling(words, _B2).of(start, stop)
    body = mix(other ^ mix((anchor - start).astype(np.uint64) * np.uint64(1 << 32) + count.astype(np.uint64)))
    key = grams[anchor]
    # In a run of one word all passages are the same: keep the first, and how many follow.
    same = np.zeros(len(start), bool)
    same[1:] = (key[1:] == key[:-1]) & (body[1:] == body[:-1]) & (start[1:] == start[:-1] + 1) & (doc[start[1:]] == doc[start[:-1]])
    keep = np.flatnonzero(~same)
    run = np.diff(np.r_[keep, len(start)])
    start, anchor, count, key, body = (x[keep] for x in (start, anchor, count, key, body))
    d = doc[start]
    return {"doc": d, "start": start - (ends - lengths)[d], "before": anchor - start, "n": count, "run": run, "key": key.view(np.int64), "body": body.view(np.int64)}


def _passage_task(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    cache = HashCache()
    ids, parts, held = [], [], 0

    def flush() -> pa.RecordBatch:
        x = passages(np.concatenate(parts), np.array([len(p) for p in parts]), window, gram)
        cols = [pa.array(np.array(ids, np.int64)[x["doc"]]), *(pa.array(x[k]) for k in ("key", "body")), *(pa.array(x[k].astype(np.int32)) for k in ("start", "before", "n", "run"))]
        return pa.record_batch(cols, ["id", "key", "body", "start", "before", "n", "run"])

    for i, data in text_rows(batches, "id", "data"):
        words = data.split() if data else []
        if i is None or len(words) < window:
            continue
        ids.append(i)
        parts.append(cache.array(words))
        held += len(words)
        if held > 100_000:
            yield flush()
            ids, parts, held = [], [], 0
    if ids:
        yield flush()


# ---- the index ----------------------------------------------------------------


class WaveletMatrix:
    """Ranks of symbols in a sequence, a level of packed bits for each bit of
    a symbol."""

    LOW = np.array([(1 << i) - 1 for i in range(64)], np.uint64)

    def __init__(self, seq: np.ndarray, bits: int):
        self.levels = []
        for b in range(bits - 1, -1, -1):
            bit = (seq >> b & 1).astype(np.uint8)
            packed = np.zeros((len(seq) // 64 + 1) * 8, np.uint8)
            raw = np.packbits(bit, bitorder="little")
            packed[: len(raw)] = raw
            words = packed.view(np.uint64)
            ones = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words)[:-1], out=ones[1:])
            self.levels.append((b, words, ones, len(seq) - int(bit.sum())))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``at``, plus the place where that
        symbol begins in the last level."""
        for b, words, ones, zeros in self.levels:
            cell = at >> 6
            one = ones[cell] + np.bitwise_count(words[cell] & self.LOW[at & 63])
            at = np.where(symbol >> b & 1, zeros + one, at - one)
        return at


class FMIndex:
    """Counts of patterns of at most ``depth`` symbols in a text of symbols
    from 1 on, pieces parted by 0."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank = text.astype(np.int64)
        order, have = np.argsort(rank, kind="stable"), 1
        while have < depth:  # prefix doubling up to the depth that patterns need
            after = np.zeros(n, np.int64)
            after[: n - have] = rank[have:] + 1
            key = rank * (rank.max() + 2) + after
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
            have *= 2
        self.order = order
        symbols = int(text.max()) + 1
        self.first = np.zeros(symbols + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=symbols), out=self.first[1:])
        bwt = text[order - 1]
        bits = max(1, int(symbols - 1).bit_length())
        self.matrix = WaveletMatrix(bwt, bits)
        all_ = np.arange(symbols)
        self.base = self.matrix.rank(all_, np.zeros(symbols, np.int64))

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns that begin with ``symbol`` and go on as
        those of [lo, hi)."""
        both = self.matrix.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        move = self.first[symbol] - self.base[symbol]
        return both[: len(lo)] + move, both[len(lo) :] + move


def least_of_ranges(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(x[lo:hi]) by a sparse table; no range is empty."""
    level, table = np.zeros(len(lo), np.int64), [x]
    size = hi - lo
    top = int(size.max()).bit_length() - 1 if len(size) else 0
    for j in range(top):
        t = table[-1]
        table.append(np.minimum(t[: len(t) - (1 << j)], t[1 << j :]))
    level = np.frexp(size.astype(float))[1] - 1
    out = np.empty(len(lo), x.dtype)
    for j in range(top + 1):
        own = level == j
        t = table[j]
        out[own] = np.minimum(t[lo[own]], t[hi[own] - (1 << j)])
    return out


def first_documents(pieces: list[np.ndarray], owner: np.ndarray, width: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of ``width`` symbols that also lies in another piece:
    its piece, its place in it, and the smallest owner of a piece that has it.
    Piece i has ``counts[i]`` windows."""
    lengths = np.array([len(p) for p in pieces])
    _, flat = np.unique(np.concatenate(pieces), return_inverse=True)
    piece = np.repeat(np.arange(len(pieces)), lengths)
    text = np.zeros(len(flat) + len(pieces) + 1, np.int64)
    text[np.arange(len(flat)) + piece] = flat + 1
    index = FMIndex(text, width)
    starts = np.cumsum(lengths + 1) - lengths - 1
    whose = np.full(len(text), len(pieces))
    whose[np.arange(len(flat)) + piece] = piece
    owners = np.append(owner, np.iinfo(np.int64).max)[whose[index.order]]
    which = np.repeat(np.arange(len(pieces)), counts)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = starts[which] + offset + width - 1
    lo, hi = index.first[text[at]], index.first[text[at] + 1]
    for _ in range(width - 1):
        open_ = hi - lo > 1  # a lone suffix is the window's own
        if not open_.all():
            which, offset, at, lo, hi = (v[open_] for v in (which, offset, at, lo, hi))
        if not len(at):
            break
        at = at - 1
        lo, hi = index.step(text[at], lo, hi)
    open_ = hi - lo > 1
    which, offset, lo, hi = (v[open_] for v in (which, offset, lo, hi))
    return which, offset, least_of_ranges(owners, lo, hi) if len(lo) else owners[:0]


# ---- tasks --------------------------------------------------------------------


def _fetch_task(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The words of the wanted passages as hashes, the anchor as one symbol."""
    cache, rows = HashCache(), []
    cols = ["key", "body", "owner", "n", "hot", "symbols"]

    def flush() -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.int32(), pa.bool_(), pa.binary()]
        return pa.record_batch([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], cols)

    for i, data, wanted in text_rows(batches, "id", "data", "wanted"):
        words = cache.array(data.split())
        for w in wanted:
            s, g = w["start"], w["start"] + w["before"]
            symbols = np.concatenate([words[s:g], [np.uint64(w["key"] & (1 << 64) - 1)], words[g + gram : s + w["n"] - 1 + window]])
            rows.append((w["key"], w["body"], i, w["n"], w["hot"], symbols.tobytes()))
        if len(rows) > 4000:
            yield flush()
            rows = []
    if rows:
        yield flush()


def _found(key, body, which, offset) -> pa.RecordBatch:
    """Runs of windows."""
    order = np.lexsort((offset, which))
    which, offset = which[order], offset[order]
    new = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (offset[1:] != offset[:-1] + 1)]) if len(which) else which
    count = np.diff(np.r_[new, len(which)])
    cols = [key[which[new]], body[which[new]], offset[new].astype(np.int32), count.astype(np.int32)]
    return pa.record_batch([pa.array(c) for c in cols], ["key", "body", "off", "n_found"])


def _index_task(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor; an index holds whole anchors."""
    held: dict[tuple[int, int], tuple] = {}
    last_key, size = None, 0

    def search() -> pa.RecordBatch:
        rows = list(held.values())
        key, body, owner, n = (np.array([r[j] for r in rows], np.int64) for j in range(4))
        which, offset, first = first_documents([np.frombuffer(r[4], np.uint64) for r in rows], owner, width, n)
        use = first < owner[which]
        return _found(key, body, which[use], offset[use])

    for row in text_rows(batches, "key", "body", "owner", "n", "symbols"):
        if row[0] != last_key and size > SHARD_WORDS:
            yield search()
            held, size = {}, 0
        last_key = row[0]
        if row[:2] not in held:
            held[row[:2]] = row
            size += len(row[4]) // 8 + 1
    if held:
        yield search()


def _window_task(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A row for each window of passages with a hot anchor."""
    for key, body, owner, n, data in text_rows(batches, "key", "body", "owner", "n", "symbols"):
        symbols, at = np.frombuffer(data, np.uint64), np.arange(n)
        h1, h2 = (Rolling(symbols, b).of(at, at + width).view(np.int64) for b in (_B1, _B2))
        cols = [*(np.full(n, v, np.int64) for v in (key, body, owner)), at.astype(np.int32), h1, h2]
        yield pa.record_batch([pa.array(c) for c in cols], ["key", "body", "owner", "off", "h1", "h2"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``(id, spans array<struct<start, stop>>)``: word ranges of each document
    that windows cover whose words also start in a document with a smaller id.
    Ranges may overlap. Rows without an id are neither searched nor indexed;
    rows that share an id are searched as one document's rows."""
    spark = docs.sparkSession
    small_batches(spark)
    n = partitions(spark)
    src = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("data"))
    kind = "id long, key long, body long, start int, before int, n int, run int"
    every = materialize(src.select("id", "data").mapInArrow(partial(_passage_task, window=window, gram=gram), kind), "passages")
    bodies = every.groupBy("key", "body").agg(F.min("id").alias("owner"), F.max("id").alias("last"))
    anchors = bodies.groupBy("key").agg(F.count("*").alias("kinds"), F.min("owner").alias("low"), F.max("last").alias("high"))
    anchors = anchors.filter("low < high").select("key", "kinds")
    shared = materialize(every.join(bodies.drop("last").join(anchors, "key"), ["key", "body"]), "shared")
    drop_table(spark, every)
    stop = F.col("start") + F.col("run") - 2 + window
    copies = shared.filter("id > owner").select("id", "start", (stop + F.col("n")).alias("stop"))
    owned = shared.filter("kinds > 1 and id = owner")
    wanted = owned.groupBy("id").agg(F.collect_list(F.struct("key", "body", "start", "before", "n", (F.col("kinds") > hot).alias("hot"))).alias("wanted"))
    kind = "key long, body long, owner long, n int, hot boolean, symbols binary"
    pieces = materialize(src.join(wanted, "id").select("id", "data", "wanted").mapInArrow(partial(_fetch_task, window=window, gram=gram), kind), "pieces")
    width = window - gram + 1
    kind = "key long, body long, off int, n_found int"
    found = pieces.filter("not hot").repartition(n, "key").sortWithinPartitions("key").mapInArrow(partial(_index_task, width=width), kind)
    windows = pieces.filter("hot").mapInArrow(partial(_window_task, width=width), "key long, body long, owner long, off int, h1 long, h2 long")
    least = windows.groupBy("h1", "h2").agg(F.min("owner").alias("low"))
    wide = windows.join(least, ["h1", "h2"]).filter("low < owner").select("key", "body", "off", F.lit(1).alias("n_found")).distinct()
    hits = materialize(found.unionByName(wide), "hits")
    drop_table(spark, pieces)
    some = owned.select("id", "key", "body", "start", "run").join(hits, ["key", "body"])
    some = some.select("id", (F.col("start") + F.col("off")).alias("start"), (stop + F.col("off") + F.col("n_found")).alias("stop"))
    return copies.unionByName(some).groupBy("id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def _remove_task(batches: Iterator[pa.RecordBatch], n_before: int, text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            texts, spans = part.column(text_at).to_pylist(), part.column(n_before).to_pylist()
            kept, n_words, n_removed, sha = [], [], [], []
            for data, own in zip(texts, spans):
                words = data.encode("utf-8").split() if data else []
                left = words
                if own:
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, [s["start"] for s in own], 1)
                    np.add.at(change, [s["stop"] for s in own], -1)
                    left = [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
                joined = b" ".join(left)
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                sha.append(hashlib.sha256(joined).hexdigest())
                kept.append(joined.decode("utf-8") if n_removed[-1] else data)
            cols = part.columns[:n_before]
            cols[text_at] = pa.array(kept, part.schema.field(text_at).type)
            cols += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha)]
            yield pa.record_batch(cols, [f"c{i}" for i in range(n_before)] + ["n_words", "n_removed", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``docs`` with repeated words taken out of ``text_col``, and the columns
    ``_n_words``, ``_n_removed`` (long) and ``_kept_sha256`` (of the kept words
    joined by single spaces).

    A text that loses words becomes its kept words joined by single spaces
    (empty if none is left); any other text, null included, stays as it is.
    A null or blank text has no words. Rows without an id keep their text.
    Rows that repeat an id all lose the words found for that id where they
    have them at the same place, which for equal rows is the same. Other
    columns pass through whatever their names."""
    if not 0 < gram <= window:
        raise ValueError("gram is between 1 and window")
    if not docs.columns:
        raise ValueError("no columns")
    spans = repeated_spans(docs, id_col, text_col, window, gram, hot)
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = names.index(id_col)
    joined = plain.join(spans, plain[f"c{at}"] == spans["id"], "left").drop("id")
    schema = T.StructType(plain.schema.fields)
    schema.add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")
    out = joined.mapInArrow(partial(_remove_task, n_before=len(names), text_at=names.index(text_col)), schema)
    return out.toDF(*names, "_n_words", "_n_removed", "_kept_sha256")


def with_length(removed: DataFrame, names: list[str], text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The columns ``names`` of ``remove_repeats``, ``length_col`` (if there)
    set to the new length of texts that lost words."""
    length = F.when(F.col("_n_removed") > 0, F.length(text_col)).otherwise(F.col(length_col)) if length_col in names else None
    out = removed if length is None else removed.withColumn(length_col, length.cast(removed.schema[length_col].dataType))
    return out.select(*names)
