"""Phrase collocations by dynamic itemset counting.

Documents are dealt into shards, which are scanned in a cycle. Single words are
counted from the first scan on. After each scan the phrases whose count has
just reached the threshold are noted; from the next scan on, a longer phrase is
counted if both phrases that it is made of (all but its last word, all but its
first) have been noted, whatever its length. Each phrase is counted from the
scan at which it began until it is noted, for one full cycle at most; the scans
end when no phrase is in its cycle and nothing new was noted.

These counts are by 64-bit hash. Phrases that share one can only be noted too
early, never missed: their counts add up. One more pass over all documents then
counts the noted phrases themselves, by their bytes; these counts are exact.

The notes are a table of ``1 << SLOT_BITS`` bytes, whatever the corpus: each
noted phrase marks three slots, chosen by its hash, with the number of the scan,
and a phrase counts as noted from the latest of its slots' numbers on, but not
before it began. Slots shared by chance make a phrase be noted too early, which
costs work but no exactness. New slots of a scan come to the driver as bit maps
(at most a bit a slot).

Counts of a scan are summed inside tasks, then by a shuffle together with those
of phrases still in their cycle; those that end it below the threshold go.
Scores are exact decimals.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .common import drop_table, materialize, small_batches

THRESHOLD, LONGEST, TOP = 100, 5, 2000
SHARDS, SLOT_BITS = 4, 24
#: Bytes of text counted together.
CHUNK_BYTES = 16 << 20
#: Phrases that a task of the last pass sums before they are shuffled.
HELD = 500_000
NEVER = 255
#: Longer words and phrases are hashed and compared one by one.
FAR_APART = 512
MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)

#: A-Z to a-z, a tab to a space, and all that ends a piece to a line feed.
NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)

#: Shifts of a hash to its slots. Its lowest bit isn't in them: it is 0 for
#: phrases of the longest length, which no other begins after.
SHIFTS = (1, 20, 40)

COUNTS = T.StructType([T.StructField("hash", T.LongType()), T.StructField("since", T.ShortType()), T.StructField("a", T.LongType())])
PHRASES = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("phrase", T.BinaryType()), T.StructField("k", T.ByteType()), T.StructField("a", T.LongType()),
])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def word_spans(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The normalised text, then eight zero bytes; its words' starts and ends
    in it; for each whether a piece ends after it."""
    normal = text.translate(NORMAL)
    plain = np.frombuffer(normal, np.uint8)
    word = np.zeros(len(plain) + 2, bool)
    word[1:-1] = (plain != 32) & (plain != 10)
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    apart = np.zeros(len(starts) + 1, bool)
    apart[np.searchsorted(starts, np.flatnonzero(plain == 10))] = True  # the words before each end of a piece
    apart[-1] = True
    return normal + bytes(8), starts, ends, apart[1:]


def split_words(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Normalised words joined by single spaces, then eight zero bytes; their
    starts and ends in it; for each whether a piece ends after it."""
    normal, first, end, apart = word_spans(text)
    if not len(first):
        return b"", first, end, apart
    plain = np.frombuffer(normal, np.uint8)
    gap = (plain == 32) | (plain == 10)
    keep = ~gap
    keep[-8:] = False
    keep[first[1:] - 1] = True  # one byte of each gap stays
    joined = np.where(gap, np.uint8(32), plain)[keep]
    length = end - first
    starts = np.append(0, np.cumsum(length + 1)[:-1])
    return joined.tobytes() + bytes(8), starts, starts + length, apart


def _noted(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The scan at whose end each phrase counts as noted, or ``NEVER``."""
    mask = np.uint64(len(table) - 1)
    out = table[(hashes >> np.uint64(SHIFTS[0])) & mask]
    for shift in SHIFTS[1:]:  # most phrases end at their first slot
        maybe = np.flatnonzero(out != NEVER)
        out[maybe] = np.maximum(out[maybe], table[(hashes[maybe] >> np.uint64(shift)) & mask])
    return out


def _eights(joined: bytes) -> np.ndarray:
    """The eight bytes from every place on, as numbers."""
    return np.ndarray((len(joined) - 7,), "<u8", joined, strides=(1,))


def word_hashes(joined: bytes, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes of all words at a time; words
    of over ``FAR_APART`` bytes one by one."""
    import xxhash

    eights, length = _eights(joined), ends - starts
    out = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    for i in np.flatnonzero(length > FAR_APART):
        out[i] = xxhash.xxh64_intdigest(joined[starts[i] : ends[i]], seed)
    left, at = np.flatnonzero(length <= FAR_APART), 0
    while len(left):
        piece = eights[starts[left] + at] & MASKS[np.minimum(length[left] - at, 8)]
        out[left] = _mix(out[left] ^ piece)
        at += 8
        left = left[length[left] > at]
    return out


def _same(joined: bytes, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> bool:
    """Whether all pairs of stretches from ``a`` and ``b`` are equal."""
    for i in np.flatnonzero((length > FAR_APART) & (a != b)):
        if joined[a[i] : a[i] + length[i]] != joined[b[i] : b[i] + length[i]]:
            return False
    eights, at = _eights(joined), 0
    left = np.flatnonzero((length <= FAR_APART) & (a != b))
    while len(left):
        mask = MASKS[np.minimum(length[left] - at, 8)]
        if ((eights[a[left] + at] ^ eights[b[left] + at]) & mask).any():
            return False
        at += 8
        left = left[length[left] > at]
    return True


def _distinct(joined: bytes, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each phrase ``joined[begin:end]``, equal for equal ones,
    and the place in the list of one of each. Hashes only sort them out: the
    bytes are compared, and decide if two phrases should share a hash."""
    code, found = pd.factorize(hashes)
    example = np.empty(len(found), np.int64)
    example[code] = np.arange(len(code))
    of, length = example[code], end - begin
    if (length != length[of]).any() or not _same(joined, begin, begin[of], length):
        phrases = np.empty(len(begin), object)
        phrases[:] = [joined[x:y] for x, y in zip(begin.tolist(), end.tolist())]
        code, found = pd.factorize(phrases)
        example = np.empty(len(found), np.int64)
        example[code] = np.arange(len(code))
    return code, example


def _places(word_hash: np.ndarray, apart: np.ndarray, table: np.ndarray, scan: int, longest: int) -> Iterator[tuple]:
    """``(k, at, hashes, began, noted)`` of the phrases that have begun by
    this scan, by length: the word they start at, their hash, the scan at which
    they began and the one at whose end they count as noted, or ``NEVER``."""
    n, one = len(word_hash), np.uint64(1)
    here = word_hash | one if longest > 1 else word_hash & ~one
    at_noted = _noted(table, here).astype(np.int16)
    yield 1, np.arange(n), here, np.zeros(n, np.int16), at_noted
    whole = np.ones(n, bool)
    for k in range(2, longest + 1):
        if n < k:
            return
        whole = whole[: n - k + 1] & ~apart[k - 2 : n - 1]
        began = np.maximum(at_noted[:-1], at_noted[1:])[: n - k + 1] + 1
        at = np.flatnonzero(whole & (began <= scan))
        if not len(at):
            return
        phrase, began = _mix(here[at] + word_hash[at + k - 1] * np.uint64(2 * k + 1)), began[at]
        phrase = phrase | one if k < longest else phrase & ~one
        # not before it began itself: slots may have been marked by other phrases
        noted = np.maximum(_noted(table, phrase), began)
        yield k, at, phrase, began, noted
        here = np.zeros(n - k + 1, np.uint64)
        here[at] = phrase
        at_noted = np.full(n - k + 1, NEVER, np.int16)
        at_noted[at] = noted


def count_chunk(text: bytes, seed: int, table: np.ndarray, scan: int, shards: int, longest: int) -> Iterator[tuple]:
    """Counts ``(hashes, since, a)`` of the phrases that are in their cycle at
    this scan and aren't noted yet."""
    normal, starts, ends, apart = word_spans(text)
    if not len(starts):
        return
    for _, _, hashes, began, noted in _places(word_hashes(normal, starts, ends, seed), apart, table, scan, longest):
        due = np.flatnonzero((scan < began + shards) & (noted == NEVER))
        hashes, began = hashes[due], began[due]
        for since in range(max(scan - shards + 1, 0), scan + 1):
            found, a = np.unique(hashes[began == since], return_counts=True)
            if len(found):
                yield found, since, a


def count_noted(text: bytes, seed: int, table: np.ndarray, longest: int) -> Iterator[tuple]:
    """Counts ``(k, phrases, a)`` of the phrases that are noted at the end, by
    their bytes, and all words as the empty phrase with ``k`` 0."""
    joined, starts, ends, apart = split_words(text)
    if not len(starts):
        return
    yield 0, [b""], np.array([len(starts)])
    for k, at, hashes, _, noted in _places(word_hashes(joined, starts, ends, seed), apart, table, NEVER, longest):
        at, hashes = at[noted != NEVER], hashes[noted != NEVER]
        if len(at):
            begin, end = starts[at], ends[at + k - 1]
            code, one = _distinct(joined, begin, end, hashes)
            yield k, [joined[x:y] for x, y in zip(begin[one].tolist(), end[one].tolist())], np.bincount(code, minlength=len(one))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Texts ``(lang, text)`` of a language joined to pieces of work."""
    waiting: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                waiting.setdefault(lang, []).append(text)
                size += len(text)
                if size >= CHUNK_BYTES:
                    yield from ((x, b"\n".join(texts)) for x, texts in waiting.items())
                    waiting.clear()
                    size = 0
    yield from ((x, b"\n".join(texts)) for x, texts in waiting.items())


def _scan(notes, scan: int, shards: int, longest: int):
    """Documents ``(lang, text)`` -> counts of a scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(zlib.decompress(notes.value), np.uint8)
        for lang, text in _chunks(batches):
            for hashes, since, a in count_chunk(text, zlib.crc32(lang.encode()), table, scan, shards, longest):
                for i in range(0, len(hashes), 100_000):
                    part = hashes[i : i + 100_000].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.full(len(part), since, np.int16)), pa.array(a[i : i + 100_000].astype(np.int64))], ["hash", "since", "a"])

    return run


def _last_pass(notes, longest: int):
    """Documents ``(lang, text)`` -> counts of noted phrases, summed over a
    task's texts as far as ``HELD`` phrases allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(zlib.decompress(notes.value), np.uint8)
        schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("k", pa.int8()), ("a", pa.int64())])
        held: dict[tuple[str, int], dict[bytes, int]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, k), counts in held.items():
                phrases, a = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
                for i in range(0, len(phrases), 100_000):
                    part = phrases[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(part)), pa.array(part, pa.binary()), pa.array(np.full(len(part), k, np.int8)), pa.array(a[i : i + 100_000])], schema=schema)
            held.clear()

        for lang, text in _chunks(batches):
            for k, phrases, a in count_noted(text, zlib.crc32(lang.encode()), table, longest):
                counts = held.setdefault((lang, k), {})
                for phrase, n in zip(phrases, a.tolist()):
                    counts[phrase] = counts.get(phrase, 0) + n
            if sum(map(len, held.values())) > HELD:
                yield from flush()
        yield from flush()

    return run


def frequent_phrases(
    docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS, slot_bits: int = SLOT_BITS,
    text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """``(lang, phrase, k, a)``: every phrase of at most ``longest`` words that
    occurs at least ``threshold`` times inside pieces, and its exact count
    (overlaps included), and all words below it in one row a language with
    ``k`` 0, the sum of all word occurrences.

    A null language is ``und``, null texts are empty; repeated rows count each
    time; bytes that aren't UTF-8 count as U+FFFD; no other columns are read."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit(""))).cast("binary").alias("text"))
    folder = f"{ensure_checkpoint_dir(spark)}/llm-shards-{np.random.default_rng().integers(1 << 62):x}"
    rows.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards))).write.option("compression", "zstd").partitionBy("shard").parquet(folder)
    shard_of = spark.read.schema("lang string, text binary, shard int").parquet(folder)
    notes = np.full(1 << slot_bits, NEVER, np.uint8)
    live, tables, scan, last = None, [], 0, -1
    while scan < shards or scan <= last + shards:
        sent = spark.sparkContext.broadcast(zlib.compress(notes.tobytes(), 1))
        part = shard_of.filter(F.col("shard") == scan % shards).select("lang", "text")
        new = part.mapInArrow(_scan(sent, scan, shards, longest), COUNTS)
        both = new if live is None else new.unionByName(live)
        summed = both.groupBy("hash").agg(F.max("since").alias("since"), F.sum("a").alias("a"))
        # what is noted is counted no more; what ended its cycle goes
        now = materialize(summed.filter((F.col("a") >= threshold) | (F.col("since") + shards - 1 > scan)), f"scan{scan}")
        if _note(now.filter(F.col("a") >= threshold), notes, scan, slot_bits):
            last = scan
        live = now.filter(F.col("a") < threshold)
        tables.append(now)
        sent.destroy()
        if scan >= NEVER - 1:
            raise ValueError("too many scans for one byte: use fewer shards")
        scan += 1
    sent = spark.sparkContext.broadcast(zlib.compress(notes.tobytes(), 1))
    # few tasks, as each has a row for nearly every phrase
    few = shard_of.select("lang", "text").coalesce(2 * spark.sparkContext.defaultParallelism)
    counts = few.mapInArrow(_last_pass(sent, longest), PHRASES)
    counts = counts.groupBy("lang", "phrase").agg(F.max("k").alias("k"), F.sum("a").alias("a"))
    out = materialize(counts.filter((F.col("a") >= threshold) | (F.col("k") == 0)), "phrases")
    sent.destroy()
    drop_table(spark, shard_of)
    for t in tables:
        drop_table(spark, t)
    return out


def _note(rows: DataFrame, notes: np.ndarray, scan: int, slot_bits: int) -> bool:
    """Mark the slots of newly frequent phrases that aren't marked yet; whether
    there are any that longer ones may begin after."""
    mask = (1 << slot_bits) - 1
    slots = F.array(*[F.shiftrightunsigned("hash", shift).bitwiseAND(F.lit(mask)) for shift in SHIFTS])

    # a bucket of a bit map holds the numbers from 1 on
    slots = rows.select(F.col("hash").bitwiseAND(F.lit(1)).alias("longer"), F.explode(slots).alias("slot")).withColumn("slot", F.col("slot") + 1)
    maps = slots.groupBy(F.bitmap_bucket_number("slot").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"), F.max("longer").alias("longer")).collect()
    for r in maps:
        at = np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")) + (r["b"] - 1) * 32768
        at = at[notes[at] == NEVER]
        notes[at] = scan
    return any(r["longer"] for r in maps)


def collocations(
    docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int | None = TOP, keep_percent: int = 100,
    shards: int = SHARDS, text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of phrases of 2 to ``longest``
    words that occur ``threshold`` times or more, per language.

    The score is ``floor(1000 a n / (l r))`` at the cut that makes it lowest,
    with ``l`` and ``r`` the counts of both parts and ``n`` all words; the cut
    after fewer words wins ties. A phrase inside a longer one with at least
    ``keep_percent`` of its occurrences goes. ``top`` phrases of a language
    remain, by score and count descending, then by phrase (bytes)."""
    found = frequent_phrases(docs, threshold, longest, shards, text_col=text_col, lang_col=lang_col)
    n = found.filter("k = 0").select(F.col("lang").alias("n_lang"), F.col("a").alias("n"))
    phrases = found.filter("k > 0").select("lang", F.col("phrase").cast("string").alias("phrase"), "k", "a")
    candidates = phrases.filter("k > 1").withColumn("words", F.split("phrase", " "))
    # every cut, with the counts of both parts
    cut = F.explode(F.sequence(F.lit(1), F.col("k").cast("int") - 1))
    cuts = candidates.select("lang", "phrase", "a", "words", cut.alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.lit(longest)), " ").alias("right"),
    )
    part = phrases.select(F.col("lang").alias("p_lang"), F.col("phrase").alias("part"), F.col("a").alias("p_a"))
    for side, name in (("left", "l"), ("right", "r")):
        other = part.withColumnsRenamed({"p_lang": "x_lang", "part": "x_part", "p_a": name})
        cuts = cuts.join(other, (F.col("lang") == F.col("x_lang")) & (F.col(side) == F.col("x_part"))).drop("x_lang", "x_part", side)
    cuts = cuts.join(n, F.col("lang") == F.col("n_lang")).drop("n_lang")
    score = F.expr("CAST(1000 * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0)) AS DECIMAL(38,0)) div CAST(CAST(l AS DECIMAL(17,0)) * CAST(r AS DECIMAL(17,0)) AS DECIMAL(38,0))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "n", "a")).alias("s")).select("lang", "phrase", "s.*")
    # the longest count of any phrase around each
    size, k = F.size("words"), F.col("k").cast("int")
    inner = candidates.filter("k > 2").select("lang", "a", "words", "k", F.explode(F.sequence(F.lit(2), k - 1)).alias("m"))
    inner = inner.select("lang", "a", "words", "m", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)).alias("at"))
    around = inner.groupBy("lang", F.array_join(F.slice("words", F.col("at"), F.col("m")), " ").alias("phrase")).agg(F.max("a").alias("outer"))
    kept = scored.join(around, ["lang", "phrase"], "left").filter(F.col("outer").isNull() | (F.lit(100) * F.col("outer") < F.lit(keep_percent) * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
