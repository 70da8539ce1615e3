"""Benchmark decontamination: windows of normalised benchmark words are looked
up in every document, in DataFrame operations only.

A window is ``length`` consecutive words of an item; an item of fewer words,
but not none, is one window. The distinct windows are a table ``(gram, items)``
that is counted and broadcast in slices of at most ``SLICE`` rows, whatever the
benchmark's size. A document's words stay in one row: positions whose first and
last word (with the length) are in a bit table of the slice's windows become
rows with the window's words, and the broadcast hash join on those words is at
once the lookup and its verification, as it compares whole windows. The bit
table only saves work; when it is full every position becomes a row.

Texts are never shuffled: only candidates and one short row a document are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

LENGTH = 10
#: Windows of the benchmark that are broadcast at once (some 100 bytes each).
SLICE = 250_000
#: Bits of the table of first and last words: 64 a window, within these bounds.
LEAST_BITS, MOST_BITS = 1 << 10, 1 << 18

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Outside words, in lower-cased and in any text.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_WORD, ANY_BETWEEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null and empty texts have none,
    and bytes that aren't UTF-8 count as U+FFFD."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), "")


def _ends(words: Column, start: Column, length: Column) -> Column:
    """Hash of the first and the last word of the window from ``start`` (1)."""
    return F.xxhash64(F.get(words, start - 1), F.get(words, start + length - 2), length)


def windows(benchmark: DataFrame, length: int = LENGTH, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(gram, n, ends, items)``: every distinct window, its words joined by
    spaces, their number, the hash of both end words and the sorted ids (as
    text; a null id is ``null``) of the items that have it. Items named twice
    are one item; texts without words have no window."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), words_of(F.col(text_col)).alias("words"))
    items = items.withColumn("n", F.least(F.size("words"), F.lit(length))).filter("n > 0")
    rows = items.select("item", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - F.col("n") + 1),
        lambda i: F.struct(F.array_join(F.slice("words", i, F.col("n")), " ").alias("gram"), _ends(F.col("words"), i, F.col("n")).alias("ends")),
    )).alias("w"))
    return rows.groupBy(F.col("w.gram").alias("gram"), "n", F.col("w.ends").alias("ends")).agg(F.sort_array(F.collect_set("item")).alias("items"))


def _bits(grams: DataFrame, count: int) -> tuple[Column, int]:
    """A constant array with 32 bits of the table in each element, and the
    number of bits; at most ``MOST_BITS`` / 32 rows come to the driver."""
    size = LEAST_BITS
    while size < MOST_BITS and size < 64 * count:
        size *= 2
    slot = F.col("ends").bitwiseAND(F.lit(size - 1))
    # summing distinct powers of two sets bits
    rows = grams.select(slot.alias("slot")).distinct().groupBy(F.shiftright("slot", 5).alias("at")).agg(F.sum(F.expr("shiftleft(1L, cast(slot & 31 AS INT))")).alias("bits")).collect()
    table = [0] * (size >> 5)
    for r in rows:
        table[r["at"]] = r["bits"]
    return F.expr("array(" + ",".join(f"{b}L" for b in table) + ")"), size


def _there(words: Column, pos: Column, lengths: list[int], bits: Column, size: int) -> dict[int, Column]:
    """For each length, whether a window of it starts at ``pos`` (from 1; the
    array's element 0 is no word) whose end words are in the table."""
    out = {}
    for n in lengths:
        slot = F.xxhash64(F.get(words, pos), F.get(words, pos + (n - 1)), F.lit(n)).bitwiseAND(F.lit(size - 1))
        word = F.get(bits, F.shiftright(slot, 5).cast("int"))
        out[n] = (pos > 0) & (pos + (n - 1) < F.size(words)) & (F.getbit(word, slot.bitwiseAND(F.lit(31)).cast("int")) == 1)
    return out


def _hits(rows: DataFrame, grams: DataFrame, most: int = SLICE) -> DataFrame:
    """``(row, id, words)`` -> ``(row, id, n_words, pos, n, items)``: a line
    for each window of the benchmark that occurs, and a line with nulls for
    each row."""
    grams = materialize(grams, "windows")
    count = grams.count()
    slices = max(1, -(-count // most))
    # Element 0 stands for the row itself and passes the filter.
    rows = rows.select("row", "id", F.concat(F.array(F.lit("")), "words").alias("words"))
    out = None
    for k in range(slices):
        part = grams.filter(F.pmod(F.xxhash64("gram"), F.lit(slices)) == k) if slices > 1 else grams
        lengths = sorted(r[0] for r in part.select("n").distinct().collect())
        bits, size = _bits(part, -(-count // slices))
        at = rows.select("row", "id", "words", F.posexplode_outer("words").alias("pos", "word")).drop("word")
        there = _there(F.col("words"), F.col("pos"), lengths, bits, size)
        found = at.filter(reduce(lambda x, y: x | y, there.values(), F.col("pos") == 0))
        # The windows' words are cut out before the second explode, which so carries no array of words.
        window = [F.when(t, F.struct(F.lit(n).alias("n"), F.array_join(F.slice("words", F.col("pos") + 1, n), " ").alias("gram"))) for n, t in there.items()]
        window = F.array(*window) if window else F.array(F.lit(None).cast("struct<n:int,gram:string>"))
        found = found.select("row", "id", (F.size("words") - 1).alias("n_words"), "pos", window.alias("w"))
        found = found.select("row", "id", "n_words", "pos", F.explode("w").alias("w")).select("row", "id", "n_words", "pos", "w.n", "w.gram")
        found = found.join(F.broadcast(part.select("gram", "items")), "gram", "left").drop("gram")
        # windows that only share their end words with the benchmark go before the shuffle
        found = found.filter((F.col("pos") == 0) | F.col("items").isNotNull())
        out = found if out is None else out.unionByName(found)
    return out


def contamination(
    docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", slice_rows: int = SLICE, row: Column | None = None,
) -> DataFrame:
    """One row for each row of ``docs``, repeated and null ids included:
    ``_row`` (its number, or ``row``), the id, ``_n_words``, ``_n_hit`` (words
    inside any occurring window), ``_items`` (sorted ids, as text, of the items
    with occurring windows) and ``_spans`` (merged, ``start`` and ``end`` word,
    counted from 1, end exclusive). Null and empty texts have no words and no
    hit; an empty benchmark hits nothing; extra columns, whatever their names,
    aren't read. Rows are numbered by their place in the input, which a reread
    table keeps."""
    at = F.monotonically_increasing_id() if row is None else row
    rows = docs.select(at.alias("row"), F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    grams = windows(benchmark, length, item_col, item_text_col)
    found = _hits(rows, grams, slice_rows).groupBy("row").agg(
        F.first("id").alias("id"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_list(F.when(F.col("items").isNotNull(), F.struct("pos", (F.col("pos") + F.col("n")).alias("end"))))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    span = "array<struct<start:int,end:int>>"
    none = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.array().cast(span).alias("done"))

    def merge(acc: Column, hit: Column) -> Column:
        apart = hit["pos"] > acc["end"]
        done = F.when(apart & (acc["end"] > 0), F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))).otherwise(acc["done"])
        return F.struct(F.when(apart, hit["pos"]).otherwise(acc["start"]).alias("start"), F.greatest(acc["end"], hit["end"]).alias("end"), done.alias("done"))

    last = lambda acc: F.when(acc["end"] > 0, F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))).otherwise(acc["done"])
    spans = F.aggregate("hits", none, merge, last)
    return found.select("row", "id", "n_words", "items", spans.alias("spans")).select(
        F.col("row").alias("_row"), F.col("id").alias(id_col), F.col("n_words").alias("_n_words"),
        F.aggregate("spans", F.lit(0), lambda acc, s: acc + s["end"] - s["start"]).alias("_n_hit"),
        F.col("items").alias("_items"), F.col("spans").alias("_spans"),
    )


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the (sorted, merged) spans and without
    what stands between each of them and the next word."""
    parts = F.regexp_extract_all(text, F.lit(f"({ANY_WORD}{ANY_BETWEEN})"), 1)
    head = F.regexp_extract(text, f"^({ANY_BETWEEN})", 1)
    ends = F.concat(F.array(F.lit(1)), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.size(parts) + 1))
    kept = F.zip_with(ends, starts, lambda e, s: F.array_join(F.slice(parts, e, s - e), ""))
    return F.concat(head, F.array_join(kept, ""))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "spans", share: float = 0.0, length: int = LENGTH,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``docs`` (all columns, in their order) without what the benchmark has:
    ``remove="spans"`` cuts hit words out of texts, ``"documents"`` leaves out
    rows of which more than ``share`` of the words are hit. Texts without a hit
    stay as they are, null ones too; repeated rows are each treated alike. The
    rows are written once, so that their numbers hold."""
    names = docs.columns
    numbered = materialize(docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("row", F.monotonically_increasing_id()), "numbered")
    text, ident = f"c{names.index(text_col)}", f"c{names.index(id_col)}"
    found = contamination(numbered, benchmark, length, ident, text, item_col, item_text_col, row=F.col("row"))
    hit = found.filter("_n_hit > 0").select(F.col("_row").alias("row"), "_n_words", "_n_hit", "_spans")
    if remove == "documents":
        kept = numbered.join(hit.filter(F.col("_n_hit") > F.lit(float(share)) * F.col("_n_words")), "row", "left_anti")
    elif remove == "spans":
        cut = F.when(F.col("_spans").isNotNull(), without_spans(F.col(text), F.col("_spans"))).otherwise(F.col(text))
        kept = numbered.join(hit, "row", "left").withColumn(text, cut)
    else:
        raise ValueError(f"remove is 'spans' or 'documents', not {remove!r}")
    return kept.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``contamination`` as digests: ``doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated``."""
    found = contamination(docs, benchmark)
    return found.select(
        "doc_id", F.col("_n_words").cast("long").alias("n_words"), F.col("_n_hit").cast("long").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"), F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("_n_hit") > 0).alias("contaminated"),
    )
