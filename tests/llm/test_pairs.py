"""Fingerprints, SimHash, lattice hashing and components against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from yieldlab.llm import editprint, lattice, simhash
from yieldlab.llm.components import components


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


# ---- components ---------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(500 + i, 501 + i) for i in range(40)] + [(900, i) for i in range(901, 960)] + [(None, 3), (7, 7)]
    u = Union()
    for a, b in edges:
        if a is not None:
            u.join(a, b)
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    nodes = {x for e in edges for x in e if x is not None}
    assert all(got.get(x, x) == u.find(x) for x in nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- SimHash ------------------------------------------------------------------


def plain_simhash(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash_components(rows):
    """{id: component} by comparing all pairs; rows are (id, print)."""
    u = Union()
    for i, (a, x) in enumerate(rows):
        for b, y in rows[i:]:
            if (x ^ y).bit_count() <= 3:
                u.join(a, b)
    return {a: u.find(a) for a, _ in rows}


def test_simhash_against_all_pairs(docs):
    got = simhash.simhash_dedup(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    assert all(r["fingerprint"] == f"{plain_simhash(texts[r['doc_id']]):016x}" for r in got)
    want = simhash_components([(i, plain_simhash(t)) for i, t in texts.items()])
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_simhash_spark_hash_is_the_same(spark):
    s = "one two three"
    assert spark.sql(f"select xxhash64('{s}')").first()[0] % (1 << 64) == xxhash.xxh64_intdigest(s.encode(), 42)


def test_simhash_odd_rows(odd_docs, no_docs):
    got = simhash.simhash_dedup(odd_docs)
    assert got.count() == odd_docs.count()
    assert got.filter("doc_id is not null and component_id > doc_id").count() == 0
    assert simhash.simhash_dedup(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0
    assert simhash.keep_one(odd_docs).filter("doc_id is null").count() == 5


@pytest.mark.parametrize("key_rows", [20_000, 60])
def test_simhash_links_of_clusters(spark, key_rows):
    """Clusters around centres, large keys dealt out in parts."""
    rng = random.Random(3)
    prints = set()
    for size in (150, 40, 3):
        centre = rng.getrandbits(64)
        for _ in range(size):
            x = centre
            for b in rng.sample(range(64), rng.randrange(5)):
                x ^= 1 << b
            prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(50)}
    rows = list(enumerate(sorted(prints)))
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x, i) for i, x in rows], "simhash long, rep long")
    u = Union()
    for a, b in simhash.links(df, 3, key_rows).collect():
        u.join(a, b)
    assert {i: u.find(i) for i, _ in rows} == simhash_components(rows)


@pytest.mark.parametrize("radius", [1, 3, 4])
def test_bit_sliced_counts(radius):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    x[50:100] = x[0] ^ (np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64))
    bits = np.unpackbits(x[:7].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    got = simhash.within(simhash.bit_planes(x), np.where(bits == 1, ~np.uint64(0), np.uint64(0)), radius)
    for q in range(7):
        assert (np.unpackbits(got[q : q + 1].view(np.uint8), bitorder="little")[:200].astype(bool) == (np.bitwise_count(x ^ x[q]) <= radius)).all()


# ---- edit embedding -----------------------------------------------------------


def plain_print(text, walk):
    c, at, out, octave = editprint.classes(text), 0, "", 0
    while c[at]:
        steps = walk.steps(octave).tolist()
        for j in range(0 if octave == 0 else 64 << (octave - 1), 64 << octave):
            if j in steps:
                out += f"{walk.codes[steps.index(j)][c[at]]:x}"
            at += walk.moves[j % editprint.PERIOD][c[at]]
        octave += 1
    while out and not out[-64:].strip("0"):  # the text ended before the octave's first sample
        out = out[:-64]
    return out


def test_edit_prints(docs):
    got = {r["doc_id"]: r for r in editprint.edit_prints(docs).collect()}
    order = sorted(docs.select("doc_id", "text").collect())
    texts = [r["text"] or "" for r in order]
    walk = editprint.Walk()
    for i, (d, _) in enumerate(order):
        t, nxt, r = texts[i], texts[(i + 1) % len(texts)], got[d]
        half = len(t) // 2
        changed = t[: len(t) - half] + nxt[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        if len(t) < 2000:
            assert r["fingerprint"] == plain_print(t, walk) and r["edited_fingerprint"] == plain_print(changed, walk)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if t == nxt:
            assert r["near_next"] == 1
    long_ = [r for r in got.values() if r["n_chars"] > 300]
    assert np.mean([r["near_edited"] for r in long_]) > np.mean([r["near_next"] for r in long_]) + 0.2


def test_small_edits_stay_near():
    rng = random.Random(2)
    walk = editprint.Walk()
    a = "".join(rng.choice("abcdefgh ijklmnop") for _ in range(4000))
    b = a[:1000] + "xyz" + a[1000:2500] + a[2504:]
    c = "".join(rng.choice("abcdefgh ijklmnop") for _ in range(4000))
    o = editprint.embed([a, b, c], walk)
    near, far = editprint.likeness(o, np.array([0, 0]), np.array([1, 2]))
    assert near > 0.85 and far < 0.25


def test_edit_prints_odd_rows(spark, odd_docs, no_docs):
    assert editprint.edit_prints(odd_docs).count() == odd_docs.count()
    assert editprint.edit_prints(no_docs).count() == 0
    one = editprint.edit_prints(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1
    assert editprint.near_duplicates(no_docs).count() == 0


def test_near_duplicates(docs, odd_docs):
    """Every pair of equal texts, and of texts one word apart, is found; no
    component joins texts whose fingerprints aren't alike."""
    rows = docs.select("doc_id", "text").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in rows}
    walk = editprint.Walk()
    ids = sorted(texts)
    o = editprint.embed([texts[i] for i in ids], walk)
    u = Union()
    for i in range(len(ids)):
        near = editprint.likeness(o, np.full(len(ids), i), np.arange(len(ids)))
        for j in np.flatnonzero(near >= 0.8):
            u.join(ids[i], ids[j])
    got = dict(editprint.near_duplicates(docs).collect())
    assert got == {i: u.find(i) for i in ids}
    parts = dict(editprint.near_duplicates(docs, key_rows=2).collect())
    assert parts == got
    assert editprint.near_duplicates(odd_docs).filter("doc_id is null and component_id is not null").count() == 0


# ---- lattice ------------------------------------------------------------------


def test_e8_decoding():
    """No lattice point near the decoded one is nearer."""
    y = np.random.default_rng(0).normal(0, 2, (2000, 8))
    c = lattice.decode_e8(y)
    twice = np.rint(2 * c).astype(int)
    assert (np.abs(2 * c - twice) < 1e-9).all()
    assert ((twice % 2 == 0).all(axis=1) | (twice % 2 != 0).all(axis=1)).all() and (c.sum(axis=1) % 2 == 0).all()
    own = ((y - c) ** 2).sum(axis=1)
    for r in lattice.ROOTS:
        assert (((y - c - r) ** 2).sum(axis=1) >= own - 1e-9).all()
    assert own.max() <= 1 + 1e-9  # the covering radius
    assert len(lattice.ROOTS) == 240 and np.allclose((lattice.ROOTS**2).sum(axis=1), 2)


def vector_rows():
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for label in (0, 1):
        for size, spread in ((60, 0.02), (25, 0.035), (40, 0.05)):
            centre = rng.normal(size=32)
            centre /= np.linalg.norm(centre)
            for _ in range(size):
                v = (centre + rng.normal(0, spread, 32)) * rng.uniform(0.5, 4)
                rows.append((n, v.astype(np.float32).tolist(), label))
                n += 1
        rows += [(n + i, rng.normal(size=32).astype(np.float32).tolist(), label) for i in range(60)]
        n += 60
    same = rows[4][1]
    rows += [(n + i, same, 0) for i in range(5)] + [(n + 5, same, 1), (n + 6, same, None), (n + 7, None, 0), (n + 8, [0.0] * 32, 0)]
    rows += [(n + 9, [float("nan")] + [1.0] * 31, 0), (n + 10, [float("inf")] * 32, 0), (n + 11, [None] + same[1:], 0), (n + 12, [1.0, 2.0], 0), (n + 13, [2.0, 4.0], 0), (n + 14, [], 0)]
    return rows


def plain_links(rows):
    ok = {i: lattice.unit(np.array([v], float))[0] for i, v, lab in rows if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: lab for i, _, lab in rows}
    u, n = Union(), {}
    for i in ok:
        for j in ok:
            if i < j and label[i] == label[j] and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= 0.93:
                u.join(i, j)
                n[i], n[j] = n.get(i, 0) + 1, n.get(j, 0) + 1
    return n, u


@pytest.mark.parametrize("cell_rows", [4000, 16])
def test_lattice_links(spark, cell_rows):
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("key", F.lit(1)).withColumn("rep", F.lit("x"))
    got = {r["vec_id"]: r for r in lattice.near_vectors(df, cell_rows=cell_rows).collect()}
    n, u = plain_links(rows)
    assert set(got) == {r[0] for r in rows}
    assert all(r["n_links"] <= n.get(i, 0) for i, r in got.items())
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * sum(n.values()) > 0
    assert all(r["component_id"] == u.find(i) and r["kept"] == (u.find(i) == i) for i, r in got.items())


def test_lattice_odd_rows(spark):
    kind = "vec_id long, embedding array<double>, label string"
    assert lattice.near_vectors(spark.createDataFrame([], kind)).count() == 0
    rows = [(1, [1.0, 0.0], "a"), (1, [1.0, 0.0], "a"), (None, [1.0, 0.0], "a"), (2, [1e-200, 0.0], "a"), (3, [1e300, 1e299], "a"), (4, [0.0, 1.0], "a")]
    got = lattice.near_vectors(spark.createDataFrame(rows, kind)).collect()
    assert len(got) == 6
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["vec_id"] is not None) == [(1, 3, 1), (1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 0, 4)]
    assert [tuple(r)[1:3] for r in got if r["vec_id"] is None] == [(0, None)]
