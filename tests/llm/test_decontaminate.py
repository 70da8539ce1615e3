"""Benchmark decontamination against a search by every window."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from yieldlab.llm import decontaminate as D

WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(WORD, lower(text))


def brute(docs, items, length=10):
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(length, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add("null" if item is None else str(item))
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[tuple(w[i : i + n])]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found, key=str.encode)).encode()).hexdigest(), bool(hit), hit))
    return out


def sample(rng):
    some = lambda n, of=30: [f"w{rng.randrange(of)}" for _ in range(n)]
    items = [(i, some(rng.randrange(1, 40))) for i in range(30)]
    items += [(100, ["solo"]), (101, ["two", "words"]), (102, []), (103, items[0][1]), (7, some(12)), (None, some(15)), (104, some(10))]
    docs = []
    for i in range(150):
        w = some(rng.randrange(0, 120))
        for _ in range(rng.randrange(0, 3)):
            _, t = rng.choice(items)
            at = rng.randrange(0, len(w) + 1)
            cut = t[rng.randrange(0, 3) :][: rng.choice([5, 9, 10, 11, 40])]
            w[at:at] = cut
        docs.append((i // 2 * 3, "".join((x.upper() if rng.random() < 0.3 else x) + rng.choice([" ", ", ", "\n", "-", " (", "__"]) for x in w)))
    docs += [(None, None), (None, "SOLO"), (5, ""), (5, "..."), (6, "äSolo solo"), (8, " ".join(some(20_000, 25)))]
    spelt = [(i, (" ".join(t) if t is not None else None)) for i, t in items] + [(200, None), (201, " .,")]
    return docs, spelt


def frames(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    for c in ("row", "id", "words", "pos", "gram", "items", "n", "_row", "c0"):
        d, b = d.withColumn(c, F.lit("x")), b.withColumn(c, F.lit("y"))
    return d, b


@pytest.mark.parametrize("slice_rows", [250_000, 40])
def test_all_rows_against_search(spark, monkeypatch, slice_rows):
    """Short items, shared windows, nulls, repeated rows and ids; also with the
    benchmark in many slices."""
    monkeypatch.setattr(D.contamination, "__defaults__", tuple(slice_rows if x == 250_000 else x for x in D.contamination.__defaults__))
    docs, items = sample(random.Random(1))
    got = sorted(tuple(r) for r in D.report(*frames(spark, docs, items)).fillna(-1, ["doc_id"]).collect())
    want = sorted((-1 if d is None else d, *rest[:-1]) for d, *rest in brute(docs, items))
    assert got == want
    assert 0 < sum(r[5] for r in want) < len(want)


def test_full_bit_table(spark, monkeypatch):
    monkeypatch.setattr(D, "LEAST_BITS", 32)
    monkeypatch.setattr(D, "MOST_BITS", 32)
    docs, items = sample(random.Random(2))
    got = sorted(tuple(r) for r in D.report(*frames(spark, docs, items)).fillna(-1, ["doc_id"]).collect())
    assert got == sorted((-1 if d is None else d, *rest[:-1]) for d, *rest in brute(docs, items))


def cut(text, hit):
    """The text without hit words and what follows them."""
    token = re.compile("([0-9A-Za-z\x80-\U0010ffff]+)[^0-9A-Za-z\x80-\U0010ffff]*")
    at = token.search(text)
    head = text[: at.start()] if at else text
    return head + "".join(m.group(0) for i, m in enumerate(token.finditer(text)) if i not in hit)


def test_spans_and_documents_removed(spark):
    docs, items = sample(random.Random(3))
    d, b = frames(spark, docs, items)
    want = brute(docs, items)
    got = D.decontaminate(d, b)
    assert got.columns == d.columns
    texts = [(i, None if t is None else t if not w[-1] else cut(t, w[-1])) for (i, t), w in zip(docs, want)]
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=key) == sorted(texts, key=key)
    kept = D.decontaminate(d, b, "documents")
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=key) == sorted([x for x, w in zip(docs, want) if not w[-1]], key=key)
    half = D.decontaminate(d, b, "documents", share=0.5)
    assert half.count() == sum(1 for w in want if not w[2] > 0.5 * w[1])


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert sorted((r["n_words"], r["n_hit"], r["contaminated"]) for r in D.report(docs, none).collect()) == [(0, 0, False), (3, 0, False)]
    assert D.report(docs.filter("false"), none).collect() == []
    assert D.decontaminate(docs, none).count() == 2


def test_no_python_and_no_shuffle_of_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = D.report(docs, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "text" not in below.splitlines()[0]


def test_invalid_bytes(spark):
    docs = spark.createDataFrame([(1, "61FF62")], "doc_id long, h string").select("doc_id", F.unhex("h").cast("string").alias("text"))
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    r = D.report(docs, items).first()
    assert (r["n_words"], r["n_hit"]) == (1, 0)
