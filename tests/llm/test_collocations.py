"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from yieldlab.llm import collocations as C


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def counts(rows, longest=5):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    return f, n


def brute(rows, least=100, longest=5, top=2000, percent=100):
    f, n = counts(rows, longest)
    out = []
    for lang, all_counts in f.items():
        often = {p: a for p, a in all_counts.items() if a >= least}
        kept = []
        for p, a in often.items():
            if len(p) < 2:
                continue
            around = [b for q, b in often.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= percent * a for b in around):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (often[p[:c]] * often[p[c:]]), c, often[p[:c]], often[p[c:]]) for c in range(1, len(p)))
            kept.append((score, a, " ".join(p), left, right))
        kept.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i, p, a, left, right, n[lang], s) for i, (s, a, p, left, right) in enumerate(kept[:top], 1)]
    return sorted(out)


def sample(rng, n, vocabulary=25):
    """Words of a skewed vocabulary, set phrases, all kinds of gaps."""
    fixed = [["New", "York", "City"], ["ice", "cream"], ["a", "b", "a", "b", "a"], ["Ünï", "☃"], ["one", "two", "three", "four", "five", "six"]]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(0, 60)):
            words += rng.choice(fixed) if rng.random() < 0.1 else [f"w{int(rng.random() ** 3 * vocabulary)}"]
        text = "".join(w + rng.choice([" "] * 8 + ["  ", "\t", ". ", ",", "\n", " ; ", "\x0b"]) for w in words)
        rows.append((rng.choice(["en", "en", "de", None]), text))
    return rows


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_against_plain_counting(spark, shards):
    rng = random.Random(shards)
    rows = sample(rng, 300) + [(None, None), ("en", ""), ("en", " .. ,"), ("xx", "alone"), ("en", "q" * 700 + " r " + "q" * 700 + " r. " + "q" * 699 + "p r"), ("en", "be " * 5000), ("und", "New York City")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    for c in ("phrase", "k", "shard", "a", "n", "hash"):
        df = df.withColumn(c, F.lit(1))
    assert found(C.collocations(df, threshold=20, shards=shards)) == brute(rows, 20)


def test_words_that_become_frequent_late(spark):
    """What reaches the threshold only at the end of its cycle still starts
    longer phrases, several scans later."""
    rows = [("en", " ".join(f"x{i}" for i in range(8)))] * 20 + [("en", "y z")] * 19
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    got = found(C.collocations(df, threshold=20, shards=5))
    assert got == brute(rows, 20) and got
    assert not [r for r in got if "y" in r[2]]


def test_a_full_table_of_notes_changes_nothing(spark, monkeypatch):
    """With 16 slots every phrase seems noted: more is counted, the same comes out."""
    rows = sample(random.Random(9), 120)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    few = C.frequent_phrases(df, 15, slot_bits=16)
    many = C.frequent_phrases(df, 15, slot_bits=24)
    with monkeypatch.context() as m:  # all phrases of a length share their hash
        m.setattr(C, "_mix", lambda x: x & x.dtype.type(0))
        one_hash = C.frequent_phrases(df, 15)
    monkeypatch.setattr(C, "_noted", lambda table, hashes: hashes.astype("u8") * 0)
    all_counted = C.frequent_phrases(df, 15, slot_bits=16)
    plain, n = counts(rows)
    want = sorted((lang, " ".join(p), a) for lang, f in plain.items() for p, a in f.items() if a >= 15)
    for out in (few, many, one_hash, all_counted):
        assert sorted((r["lang"], bytes(r["phrase"]).decode(), r["a"]) for r in out.filter("k > 0").collect()) == want
        assert {r["lang"]: r["a"] for r in out.filter("k = 0").collect()} == dict(n)


def test_top_and_percent(spark):
    rows = sample(random.Random(2), 200)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert found(C.collocations(df, threshold=20, top=5, keep_percent=60)) == brute(rows, 20, top=5, percent=60)


def test_empty(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert C.collocations(df).collect() == []
    assert C.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).collect() == []


def test_invalid_bytes(spark):
    df = spark.createDataFrame([("41FF20422E",)] * 30, "h string").select(F.lit("en").alias("lang"), F.unhex("h").cast("string").alias("text"))
    got = C.collocations(df, threshold=20).select(F.col("phrase").cast("binary").alias("p"), "a").collect()
    assert [(bytes(r["p"]), r["a"]) for r in got] == [("a\ufffd b".encode(), 30)]


def test_large_products_are_exact(spark, monkeypatch):
    """Products past 64 bits: counts as if a corpus of 10^13 words."""
    big = [("en", b"", 0, 10**13 + 7), ("en", b"p", 1, 3 * 10**9 + 1), ("en", b"q", 1, 2 * 10**9 + 3), ("en", b"p q", 2, 10**9 + 9)]
    monkeypatch.setattr(C, "frequent_phrases", lambda *a, **k: spark.createDataFrame([(x, bytearray(p), k, a) for x, p, k, a in big], "lang string, phrase binary, k byte, a long"))
    r = C.collocations(None).first()
    assert r["score"] == 1000 * (10**9 + 9) * (10**13 + 7) // ((3 * 10**9 + 1) * (2 * 10**9 + 3))


def test_words_are_told_apart_by_their_bytes():
    """Hashes follow the bytes, at any length and place; equal ones are equal."""
    rng = random.Random(7)
    words = [bytes(rng.choice(b"ab") for _ in range(rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 40, 511, 512, 513, 900]))) for _ in range(400)]
    joined, starts, ends, _ = C.split_words(b" ".join(words))
    assert [joined[x:y] for x, y in zip(starts, ends)] == words
    hashes = C.word_hashes(joined, starts, ends, 5)
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))
    for h in (hashes, hashes & hashes.dtype.type(3)):  # also when hashes clash
        code, one = C._distinct(joined, starts, ends, h)
        assert len(one) == len(set(words)) and all(words[one[c]] == w for c, w in zip(code, words))


def test_words_and_ends_of_pieces():
    """Any gaps: words, and after which of them a piece ends."""
    rng = random.Random(11)
    for _ in range(300):
        text = "".join(rng.choice("aB\0 \t\n.,;\x0b") for _ in range(rng.randrange(0, 30)))
        pieces = [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text))]
        words = [w.encode() for p in pieces for w in p]
        last = [i == len(p) - 1 for p in pieces for i in range(len(p))]
        for split in (C.word_spans, C.split_words):
            data, starts, ends, apart = split(text.encode())
            assert [data[x:y] for x, y in zip(starts, ends)] == words and apart.tolist() == last
        assert data.rstrip(b"\0") == b" ".join(words).rstrip(b"\0")


def test_scans_carry_numbers_only(spark, monkeypatch):
    """The counts of a scan are keyed by hash, and what is noted isn't counted
    again; phrases are moved once, at the end."""
    made = {}
    real = C.materialize

    def spy(df, label):
        made[label] = real(df, label)
        made[label].cache().count()
        return made[label]

    monkeypatch.setattr(C, "materialize", spy)
    rows = [("en", "often seen words")] * 400 + [("en", f"rare{i} words") for i in range(40)]
    out = C.frequent_phrases(spark.createDataFrame(rows, "lang string, text string").coalesce(1), 20, shards=2)
    plain, _ = counts(rows)
    assert {bytes(r["phrase"]).decode(): r["a"] for r in out.filter("k > 0").collect()} == {" ".join(p): a for p, a in plain["en"].items() if a >= 20}
    scans = [t for label, t in made.items() if label.startswith("scan")]
    assert len(scans) > 2 and all(set(t.dtypes) == {("hash", "bigint"), ("since", "smallint"), ("a", "bigint")} for t in scans)
    # three words, two pairs and one triple reach the threshold, each in one scan only
    assert sum(t.filter("a >= 20").count() for t in scans) == 6
    for t in made.values():
        t.unpersist()


def test_last_pass_sums_a_task(monkeypatch):
    """One row a phrase for all texts of a task, however they are cut; with
    little room the sums are the same."""
    import zlib
    from types import SimpleNamespace

    import pyarrow as pa

    rng = random.Random(4)
    rows = sample(rng, 60)
    texts = [(lang or "und", text.encode()) for lang, text in rows]
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _ in texts]), pa.array([y for _, y in texts], pa.binary())], ["lang", "text"])
    notes = SimpleNamespace(value=zlib.compress(bytes(1 << 16)))  # all noted
    plain, n = counts(rows)
    want = {(lang, " ".join(p)): a for lang, f in plain.items() for p, a in f.items()} | {(lang, ""): a for lang, a in n.items()}
    monkeypatch.setattr(C, "CHUNK_BYTES", 500)
    for held in (10**6, 100):
        monkeypatch.setattr(C, "HELD", held)
        found, made = defaultdict(int), 0
        for out in C._last_pass(notes, 5)(iter([batch])):
            for r in out.to_pylist():
                found[r["lang"], r["phrase"].decode()] += r["a"]
                made += 1
        assert found == want and (made == len(want)) == (held == 10**6)
