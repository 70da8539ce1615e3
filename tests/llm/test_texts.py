"""Substrings, language model, quality, pieces and section tokens."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldlab.llm import hmm, pieces, quality, substring, tokencount

tokenizers = pytest.importorskip("public_tokenizers")


# ---- substrings ---------------------------------------------------------------


def plain_removal(rows, window=50):
    """{id: (n_words, n_removed, kept)} of unique ids."""
    words = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i in sorted(words):
        for s in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][s : s + window]), i)
    out = {}
    for i, w in words.items():
        gone = np.zeros(len(w), bool)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < i:
                gone[s : s + window] = True
        out[i] = (len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g))
    return out


@pytest.mark.parametrize("how", [{}, {"hot": 1}, {"gram": 50}, {"window": 12, "gram": 4}, {"window": 12, "gram": 4, "hot": 1}, {"window": 3, "gram": 1}])
def test_removal(docs, how):
    out = substring.remove_repeats(docs, **how)
    assert out.columns[: len(docs.columns)] == docs.columns
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = plain_removal(rows.items(), how.get("window", 50))
    removed = 0
    for r in out.collect():
        n, gone, kept = want[r["doc_id"]]
        assert (r["_n_words"], r["_n_removed"], r["_kept_sha256"]) == (n, gone, hashlib.sha256(kept).hexdigest())
        assert r["text"] == (kept.decode() if gone else rows[r["doc_id"]])
        removed += gone
    assert removed > 200


def test_removal_odd_rows(odd_docs, no_docs):
    out = substring.remove_repeats(odd_docs).collect()
    assert len(out) == odd_docs.count()
    assert all(r["_n_removed"] == 0 for r in out if r["doc_id"] is None)
    same = {}
    for r in out:
        if r["doc_id"] is not None:
            assert same.setdefault(r["doc_id"], r["_kept_sha256"]) == r["_kept_sha256"]
    assert substring.remove_repeats(no_docs).count() == 0


def test_new_length(docs):
    out = substring.with_length(substring.remove_repeats(docs), docs.columns)
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert out.filter(F.col("n_chars") != F.length("text")).count() == 0


def test_fm_index_counts():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 6, 3000)
    text[::41] = 0
    text[-1] = 0
    index = substring.FMIndex(text, 16)
    for _ in range(200):
        at = int(rng.integers(0, 2980))
        p = text[at : at + int(rng.integers(1, 9))]
        p = p[: int(np.argmin(p))] if (p == 0).any() else p
        if not len(p):
            continue
        lo, hi = np.array([0]), np.array([len(text)])
        for s in p[::-1]:
            lo, hi = index.step(np.array([s]), lo, hi)
        brute = sum((text[i : i + len(p)] == p).all() for i in range(len(text) - len(p) + 1))
        assert hi[0] - lo[0] == brute
        assert all((text[i : i + len(p)] == p).all() for i in index.order[lo[0] : hi[0]])


def test_first_minimum():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 5, 60)
    for width in (1, 2, 5, 31):
        assert substring.first_minimum(x, width).tolist() == [i + int(np.argmin(x[i : i + width])) for i in range(60 - width + 1)]


# ---- language model -----------------------------------------------------------


def token_rows(df):
    rows = sorted(df.select("doc_id", "text").collect(), key=lambda r: r["doc_id"])
    return [(r["doc_id"], (r["text"] or "").encode().lower().split() + [None]) for r in rows]


@pytest.fixture(scope="module")
def scored(docs):
    return {r["doc_id"]: r for r in hmm.score_texts(docs, passes=2).collect()}


def test_base_scores(docs, scored):
    rows = token_rows(docs)
    learn = [t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for t in learn for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        r = scored[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(c[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))
        assert r["score"] < 0


def test_states_are_learnt(spark):
    """Texts of two languages: the states tell them apart, the base can't."""
    rng = random.Random(1)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{min(rng.randrange(1, 60), rng.randrange(1, 60))}" for _ in range(rng.randrange(20, 200)))) for i in range(400)]
    got = hmm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), states=4).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert got[0] / got[2] > got[1] / got[2] + 0.2  # of log10 2 = 0.30


def test_forward_is_exact():
    rng = np.random.default_rng(0)
    model = hmm.Model.noise(rng.dirichlet(np.ones(30)), 4, 3)
    lengths = np.array([1, 5, 2500, 700, 3000, 2048, 2049])
    symbols, extra = rng.integers(0, 30, lengths.sum()), rng.normal(size=lengths.sum())
    got, at = hmm.forward(symbols, extra, lengths, model), 0
    for n, value in zip(lengths, got):
        a, log = model.begin * model.emit[symbols[at]], extra[at : at + n].sum()
        for s in symbols[at + 1 : at + n]:
            log, a = log + np.log(a.sum()), a / a.sum()
            a = (a @ model.move) * model.emit[s]
        assert value == pytest.approx(log + np.log(a.sum()))
        at += n


def test_expected_counts():
    """Against the sum over all paths, and likelihood never falls in training."""
    rng = np.random.default_rng(4)
    prior = rng.dirichlet(np.ones(5))
    model = hmm.Model.noise(prior, 2, 1)
    symbols, start, size = np.array([0, 3, 1, 4, 4, 2]), np.array([0, 4]), np.array([4, 2])
    counts, moves, begins = np.zeros((5, 2)), np.zeros((2, 2)), np.zeros(2)
    for s, n in zip(start, size):
        paths = {}
        for p in np.ndindex(*(2,) * n):
            q = model.begin[p[0]] * model.emit[symbols[s], p[0]]
            for t in range(1, n):
                q *= model.move[p[t - 1], p[t]] * model.emit[symbols[s + t], p[t]]
            paths[p] = q
        total = sum(paths.values())
        for p, q in paths.items():
            begins[p[0]] += q / total
            for t in range(n):
                counts[symbols[s + t], p[t]] += q / total
                if t:
                    moves[p[t - 1], p[t]] += q / total
    got = hmm.expected(symbols, start, size, model)
    for a, b in zip(got, (counts, moves, begins)):
        assert np.allclose(a, b)
    flat = rng.integers(0, 5, 600)
    start, size, _ = hmm.sequences(np.array([300, 250, 50]), 64)
    prior = np.bincount(flat, minlength=5) / 600
    last = -np.inf
    for _ in range(8):
        *counts, log = hmm.expected(flat, start, size, model)
        assert log >= last - 1e-3 * abs(log)
        model, last = hmm.Model.learn(*counts, prior), log


def test_language_model_odd_rows(spark, odd_docs, no_docs):
    got = hmm.score_texts(odd_docs, passes=1)
    assert got.count() == odd_docs.count()
    assert got.filter("held_out is null or score is null or isnan(score)").count() == 0
    assert hmm.score_texts(no_docs).count() == 0
    out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    only = hmm.score_texts(spark.createDataFrame([(out, "a b")], "doc_id long, text string")).first()
    assert (only["train_tokens"], only["n_known"], only["base_score"]) == (0, 0, 0.0) and only["score"] == pytest.approx(0.0)


# ---- quality ------------------------------------------------------------------


def quality_rows():
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(900):
        good = rng.random() < 0.8
        w = [f"{rng.choice('abcdefgh')}{rng.choice('lmnop')}{rng.randrange(50)}" for _ in range(rng.randrange(20, 120))]
        text = " ".join(w) + "." if good else " ".join(f"{x.upper()}!!" for x in w) if i % 2 else " ".join([w[0]] * 60)
        rows.append((i, text, "other"))
        if i % 3:
            labels.append((i, int(good)))
    rows += [(900, None, None), (901, "", "x"), (902, "  \n", "x")]
    return rows, labels + [(5000, 1), (3, None), (None, 0)]


def test_quality(spark):
    rows, labels = quality_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, x string").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.score_quality(docs, lab).collect()}
    assert set(got) == {r[0] for r in rows}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[i]["predicted"], y) for i, y in labels if i in got and y is not None and got[i]["held_out"]]
    assert len(held) > 50 and sum(p == y for p, y in held) / len(held) > 0.95
    kept = quality.keep_good(docs, lab)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["predicted"]}
    # a score is the text's alone
    other = quality.score_quality(docs, lab.filter("pmod(crc32(cast(cast(doc_id as string) as binary)), 5) <> 0"))
    assert {r["doc_id"]: r["score"] for r in other.collect()} == pytest.approx({i: r["score"] for i, r in got.items()})


def test_quality_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.score_quality(odd_docs, none)
    assert got.count() == odd_docs.count() and got.filter("score not between 0.4 and 0.6 or held_out is null").count() == 0
    assert quality.score_quality(no_docs, none).count() == 0 and quality.keep_good(no_docs, none).count() == 0
    one = odd_docs.select("doc_id").filter("doc_id is not null").distinct().withColumn("quality", F.lit(1))
    assert quality.score_quality(odd_docs, one).filter("predicted = 0").count() == 0


def test_pooling():
    x, n, y = np.arange(6.0), np.array([2, 1, 1, 4, 1, 1.0]), np.array([0, 1, 0, 2, 1, 1.0])
    at, value = quality.pool(x, n, y)
    assert (np.diff(value) > 0).all() and value.tolist() == pytest.approx([0, 0.5, 1.0]) and at[0] == 0


def test_random_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, len(quality.STATISTICS)))
    z = quality.Waves(np.zeros(x.shape[1]), np.ones(x.shape[1]), waves=20_000)(x)[:, :-1]
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-d / (2 * x.shape[1] * quality.WIDTH**2))).max() < 0.05


# ---- pieces -------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    with open(tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(model):
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def random_texts(pieces_of):
    rng = random.Random(9)
    letters = "ab cd  eth\n\t▁é日本ion the  ing\x00\U0001f600ñß…0123 "
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(800)]
    out += ["".join(rng.choice(pieces_of[300:]).replace("▁", rng.choice([" ", ""])) for _ in range(rng.randrange(1, 12))) for _ in range(4000)]
    return out + ["", " ", "   ", " a", "a ", "\n", "\n a", " " * 40, "aaaa" * 50, "=" * 100, "<s>", "</s><unk>", "▁", "the" * 3000]


def test_encoding_is_the_librarys(model, library):
    vocab = pieces.Vocabulary(model)
    texts = random_texts(vocab.pieces)
    got = [[i for w in t for i in w] for t in pieces.Encoder(vocab).encode(texts, lambda ids: ids)]
    want = library.encode(texts, num_threads=1)
    assert got == want
    assert [pieces.decode_ids(vocab, t) for t in want] == [library.decode(t) for t in want]


def test_long_words(model, library):
    """A megabyte without a break costs n log n steps, and has the library's ids."""
    rng = random.Random(5)
    n = 1_000_000
    texts = [" " * n, "e" * n, "-" * n, "ab" * (n // 2), "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))]
    encoder = pieces.Encoder(pieces.Vocabulary(model))
    for text in texts:
        begin = time.process_time()
        got = [i for w in next(encoder.encode([text], lambda ids: ids)) for i in w]
        spent = time.process_time() - begin
        assert got == library.encode(text) and spent < 30


@pytest.mark.parametrize("alphabet", [" ", "e ", "aeh", "=-", " \t", "日本e", "é☃ \n", "the in", "."])
def test_heap_equals_rounds_and_library(model, library, monkeypatch, alphabet):
    rng = random.Random(alphabet)
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 400))) for _ in range(60)]
    want = library.encode(texts)
    for most in (0, 3, pieces.LONG, 10_000):
        monkeypatch.setattr(pieces, "LONG", most)
        got = [[i for w in t for i in w] for t in pieces.Encoder(pieces.Vocabulary(model)).encode(texts, lambda ids: ids)]
        assert got == want


def test_decoding_is_the_librarys(model, library):
    vocab, rng = pieces.Vocabulary(model), random.Random(2)
    for _ in range(1500):
        ids = [rng.choice([rng.randint(3, 258), rng.randrange(32000), rng.randint(259, 300)]) for _ in range(rng.randrange(9))]
        assert pieces.decode_ids(vocab, ids) == library.decode(ids)


def test_round_trip(odd_docs, no_docs, model, library):
    rows = odd_docs.select("doc_id", "text").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = sorted(((-1 if i is None else i), len(ids := library.encode(t or "")), sha(",".join(map(str, ids))), sha(library.decode(ids))) for i, t in rows)
    got = sorted(((-1 if r[0] is None else r[0]), *r[1:]) for r in pieces.round_trip(odd_docs, model).collect())
    assert got == want
    assert pieces.round_trip(no_docs, model).count() == 0
    full = pieces.decode(pieces.encode(odd_docs, model), model).collect()
    assert len(full) == len(rows) and all(r["token_ids"] == library.encode(r["text"] or "") and r["decoded"] == (r["text"] or "") for r in full)
    assert pieces.encode(no_docs, model).columns == [*no_docs.columns, "token_ids"]


# ---- section tokens -----------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    with open(tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read()


def plain_sections(tokenizer, text, spans, rule):
    """Tokens of each section by walking every byte; spans are in bytes."""
    ids = tokenizer.encode_ordinary(text)
    owner = {}
    for s, (a, b) in enumerate(spans):
        owner.update(dict.fromkeys(range(a, b), s))
    out, at = Counter(), 0
    for i in ids:
        n = len(tokenizer.decode_single_token_bytes(i))
        own = [owner.get(p, -1) for p in range(at, at + n)]
        if rule == "start":
            out[own[0]] += 1
        elif rule == "shares":
            for s in own:
                out[s] += 1 / n
        else:
            runs = [[own[0], 0]]
            for s in own:
                if s != runs[-1][0]:
                    runs.append([s, 0])
                runs[-1][1] += 1
            out[max(runs, key=lambda r: r[1])[0]] += 1
        at += n
    return out, len(ids)


@pytest.mark.parametrize("rule", tokencount.RULES)
def test_line_tokens(spark, docs, ranks, rule):
    tokenizer, _ = tokencount.load(ranks, tokenizers.PATTERN)
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice(["the ", "word", "\n", "\n\n", "  ", "é", "日本", "ing\n", ".\n\n\n"]) for _ in range(rng.randrange(80)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "\n"), (63, "no break")]
    got = {}
    for r in tokencount.section_tokens(spark.createDataFrame(rows, "doc_id long, text string"), ranks, tokenizers.PATTERN, rule=rule).collect():
        got.setdefault(r["doc_id"], {})[r["section"]] = r
    assert set(got) == {r[0] for r in rows}
    for i, text in rows:
        data = (text or "").encode()
        lines = data.split(b"\n")
        lines = [x + b"\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
        ends = np.cumsum([len(x) for x in lines]).tolist()
        spans = list(zip([0, *ends], ends))
        want, n = plain_sections(tokenizer, text or "", spans, rule)
        assert all(r["doc_tokens"] == n for r in got[i].values())
        assert [(got[i][s]["start_byte"], got[i][s]["stop_byte"]) for s in range(len(spans))] == spans
        assert {s: r["n_tokens"] for s, r in got[i].items() if r["n_tokens"]} == pytest.approx({s: c for s, c in want.items() if c})
        assert sum(r["n_tokens"] for r in got[i].values()) == pytest.approx(n)


def test_given_sections(spark, odd_docs, no_docs, ranks):
    tokenizer, _ = tokencount.load(ranks, tokenizers.PATTERN)
    text = "Títle: a heading\nBody of the téxt 日本 and more."
    spans = [(0, 6), (17, 30), None, (None, 3), (33, 900), (5, 5)]
    df = spark.createDataFrame([(1, text, spans), (2, text, None), (3, None, [(0, 4)])], "doc_id long, text string, parts array<struct<start:long,stop:long>>")
    cuts = [tuple(len(text[:c].encode()) for c in s) for s in ((0, 6), (17, 30), (33, len(text)))]
    for rule in tokencount.RULES:
        rows = tokencount.section_tokens(df, ranks, tokenizers.PATTERN, sections_col="parts", rule=rule).collect()
        want, n = plain_sections(tokenizer, text, cuts, rule)
        assert {r["section"]: r["n_tokens"] for r in rows if r["doc_id"] == 1 and r["n_tokens"]} == pytest.approx({s: c for s, c in want.items() if c})
        assert [(r["section"], r["n_tokens"]) for r in rows if r["doc_id"] == 2] == [(-1, n)]
        assert [(r["section"], r["n_tokens"]) for r in rows if r["doc_id"] == 3] == [(-1, 0)]
    out = tokencount.section_tokens(odd_docs, ranks, tokenizers.PATTERN).groupBy("doc_id").count()
    assert out.count() == odd_docs.select("doc_id").distinct().count()
    assert tokencount.section_tokens(no_docs, ranks, tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        tokencount.section_tokens(docs_of(spark), ranks, tokenizers.PATTERN, rule="none")


def docs_of(spark):
    return spark.createDataFrame([(1, "a")], "doc_id long, text string")
