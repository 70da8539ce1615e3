"""Mixing, WARC archives, the registered queries and the pipeline."""

import hashlib
import math
import os
import random
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from yieldlab.llm import mixing, warc  # noqa: E402
from yieldlab.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


# ---- mixing -------------------------------------------------------------------


def plain_count(rate, key, seed=1):
    """Inverse Poisson distribution at the hashed numbers."""
    if not rate:
        return 0
    draws, total = max(math.ceil(rate / mixing.RATE), 1), 0
    for i in range(1, draws + 1):
        u = int(hashlib.md5(f"{seed}:{key}:{i}".encode()).hexdigest()[:13], 16) / (1 << 52)
        p = s = math.exp(-rate / draws)
        k = 0
        while u >= s and k < mixing.TAIL + 1:
            k += 1
            p = p * (rate / draws) / k
            s += p
        total += k
    return total


def test_counts_and_rates(spark, docs):
    targets = spark.createDataFrame([("s0", 1.0), ("s1", 4.0), ("s1", 4.0), (None, 2.0), ("s2", -1.0), ("unknown", 9.0), ("s3", None)], "source string, weight double")
    rows = docs.select("doc_id", "source").collect()
    sizes = Counter(r["source"] for r in rows)
    weights = {"s0": 1.0, "s1": 8.0, None: 2.0}
    rate = {s: weights.get(s, 0) / 11 * 30 * len(rows) / n for s, n in sizes.items()}
    got = {r["source"]: r["rate"] for r in mixing.rates(docs, targets, epochs=30).collect()}
    assert got == pytest.approx(rate)
    out = mixing.mix_sources(docs, targets, epochs=30)
    assert out.columns[: len(docs.columns)] == docs.columns
    copies = Counter(r["doc_id"] for r in out.select("doc_id").collect())
    assert {i: c for i, c in copies.items()} == {i: k for i, s in rows if (k := plain_count(rate[s], i))}
    nums = out.select("doc_id", "_copy").collect()
    assert len(set(nums)) == len(nums) and max(r["_copy"] for r in nums) == max(copies.values())


def test_poisson_mean(spark):
    df = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 8 == 0, "small").otherwise("large").alias("source"))
    n = dict(mixing.mix_sources(df, power=0.0, epochs=1.0).groupBy("source").count().collect())
    assert n["small"] == pytest.approx(20_000, rel=0.03) and n["large"] == pytest.approx(20_000, rel=0.03)


@pytest.mark.parametrize("small", [mixing.SMALL, 0])
def test_null_and_repeated_ids_draw_apart(spark, monkeypatch, small):
    """Sources whose rows have no id, or one id between them, or are all the
    same, keep their mean; rows with an id of their own draw as ever."""
    monkeypatch.setattr(mixing, "SMALL", small)
    n = 6000
    kind = F.element_at(F.array(*map(F.lit, ("none", "one", "pairs", "own"))), (F.col("id") % 4 + 1).cast("int"))
    key = F.when(kind == "none", None).when(kind == "one", -1).when(kind == "pairs", -2 - F.floor(F.col("id") / 8)).otherwise(F.col("id"))
    df = spark.range(4 * n).select(key.cast("long").alias("doc_id"), kind.alias("source"), F.lit("same").alias("text"))
    out = mixing.mix_sources(df, power=0.0)
    got = {r["source"]: r for r in out.groupBy("source").agg(F.count("*").alias("n"), F.max("_copy").alias("most")).collect()}
    for source in ("none", "one", "pairs", "own"):
        assert got[source]["n"] == pytest.approx(n, rel=0.06) and got[source]["most"] > 3
    own = Counter(r["doc_id"] for r in out.filter("source = 'own'").select("doc_id").collect())
    assert own == {i: k for i in range(3, 4 * n, 4) if (k := plain_count(1.0, i))}
    assert mixing.mix_sources(df, power=0.0).groupBy("source").count().exceptAll(out.groupBy("source").count()).isEmpty()


def test_names_like_the_extra_columns_stay(spark):
    df = spark.createDataFrame([(i, "a", -i, "r", "o", "x") for i in range(50)], "doc_id long, source string, _copy long, _rate string, _order string, row string")
    out = mixing.mix_sources(df, extras=False)
    assert out.columns == df.columns
    assert all(r["_copy"] == -r["doc_id"] and tuple(r)[3:] == ("r", "o", "x") for r in out.collect())
    assert corpus_pipeline.mixing_stage(spark, df, SF).columns == df.columns


def test_shuffle_is_global(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    order = [r["doc_id"] for r in mixing.mix_sources(df).collect()]
    up = sum(a < b for a, b in zip(order, order[1:])) / len(order)
    assert 0.45 < up < 0.55


def test_mixing_is_native(docs):
    plan = mixing.mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian"))


def test_mixing_odd_rows(spark, odd_docs, no_docs):
    assert mixing.mix_sources(no_docs).count() == 0
    assert mixing.mix_sources(odd_docs, epochs=3).count() > 0
    assert mixing.mix_sources(odd_docs, spark.createDataFrame([], "source string, weight double")).count() == 0
    a, b = (mixing.mix_sources(odd_docs, seed=s).count() for s in (1, 1))
    assert a == b


# ---- WARC ---------------------------------------------------------------------


def page_rows():
    rng = random.Random(7)
    big = "<p>" + "".join(rng.choice("abc é日\r\n") for _ in range(30_000))
    rows = [(i, f"http://x/{i}", "".join(rng.choice("abcdef <>\r\né日\U0001f600") for _ in range(rng.randrange(0, 6000)))) for i in range(60)]
    rows += [(100 + i, f"http://big/{i}", big) for i in range(5)] + [(200 + i, None, "tiny") for i in range(3)]
    rows += [(300, "http://n/", None), (301, "u", ""), (302, "line\r\nWARC-Type: x", "WARC/1.1\r\nContent-Length: 3\r\n\r\n" * 200), (303, "u", "0\r\n\r\n" * 400), (304, "u", "x" * 1000), (305, "u", "x" * 1000), (306, "u", "y" * 999), (307, "u", "y" * 999)]
    return rows


def plain_report(rows):
    payload = {i: (h or "").encode() for i, _, h in rows}
    last = {}
    for i, p in payload.items():
        last[p] = max(last.get(p, i), i)
    out = set()
    for i, p in payload.items():
        old = len(p) >= 1000 and last[p] != i
        out.add((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if old else "response", last[p] if old else None))
    return out


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archive_round_trip(spark, tmp_path, compression):
    rows = page_rows()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("last", F.lit(2)).repartition(3)
    path = f"file://{tmp_path}/archive"
    warc.write_archive(warc.plan_records(df), path, segment_chars=5000, chunk_chars=700, file_rows=30, compression=compression)
    records = warc.read_records(spark, path)
    assert records.filter("type = 'continuation'").count() > 5
    back = warc.reassemble(records)
    assert back.filter("not whole").count() == 0
    html = {i: (h or "").encode() for i, _, h in rows}
    for r in back.filter("type = 'response'").collect():
        assert bytes(r["payload"]) == html[int(r["record_id"].split(":")[2].split("#")[0])]
    assert {tuple(r) for r in warc.page_report(back).collect()} == plain_report(rows)


def test_broken_segments(spark):
    """A missing, a repeated and a short segment, and a wrong digest."""
    kind = "type string, record_id string, uri string, digest string, refers_to string, origin string, segment int, total long, block binary"
    head = b"HTTP/1.1 200 OK\r\n\r\n"

    def parts(name, *more, digest=None):
        return [("response", name, "u", digest, None, None, 1, None, head + b"ab")] + [("continuation", f"{name}{i}", "u", None, None, name, *m) for i, m in enumerate(more)]

    good = f"sha1:{hashlib.sha1(b'abcd').hexdigest()}"
    rows = parts("whole", (3, 23, b"d"), (2, None, b"c"), digest=good) + parts("missing", (3, 23, b"d")) + parts("twice", (2, None, b"c"), (2, None, b"c"), (3, 24, b"d"))
    rows += parts("short", (2, None, b""), (3, 23, b"d")) + parts("wrong", (2, 23, b"cd"), digest="sha1:00") + [("continuation", "lost1", "u", None, None, "lost", 2, 5, b"x")] + parts("endless", (2, None, b"cd"))
    got = {r["record_id"]: (r["whole"], r["payload"] and bytes(r["payload"])) for r in warc.reassemble(spark.createDataFrame(rows, kind)).collect()}
    assert got == {"whole": (True, b"abcd"), "missing": (False, None), "twice": (False, None), "short": (False, None), "wrong": (False, None), "endless": (False, None)}


def test_archive_odd_rows(spark, tmp_path):
    kind = "page_id long, url string, html string"
    rows = [(1, "u", "z" * 3000), (1, "u", "z" * 3000), (1, "v", "q" * 2500), (None, "u", "w" * 2000), (None, None, None), (2, "u", "z" * 3000), (0, "u", "z" * 3000)]
    path = f"file://{tmp_path}/odd"
    warc.write_archive(warc.plan_records(spark.createDataFrame(rows, kind)), path, segment_chars=900)
    got = warc.page_report(warc.read_archive(spark, path)).collect()
    assert len(got) == len(rows)
    assert sorted(r["payload_bytes"] for r in got) == sorted(len(r[2] or "") for r in rows)
    assert sorted(str(r["refers_to"]) for r in got if r["record_type"] == "revisit") == ["2", "2", "2"]
    empty = f"file://{tmp_path}/none"
    warc.write_archive(warc.plan_records(spark.createDataFrame([], kind)), empty)
    assert warc.page_report(warc.read_archive(spark, empty)).count() == 0


def test_reader_takes_plain_bodies_and_chunk_extensions():
    assert warc.dechunk(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\r\n\r\n") == b"body\r\n\r\n"
    assert warc.dechunk(b"HTTP/1.1 200 OK\r\ntransfer-encoding: Chunked\r\n\r\n3;x=y\r\nabc\r\n1\r\nd\r\n0\r\n\r\n") == b"abcd"
    with pytest.raises(ValueError):
        warc.dechunk(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabcd\r\n0\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nshort"))


# ---- pipeline -----------------------------------------------------------------


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.schema.simpleString() == docs.schema.simpleString()
        docs = corpus_pipeline.materialize(out, name)
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] and sizes[3] == sizes[4] > 0
    again = corpus_pipeline.run(spark, SF)
    assert again.count() == sizes[-1] and again.columns == docs.columns


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_stages_of_odd_rows(spark, odd_docs):
    docs = odd_docs.withColumn("lang", F.lit("en"))
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name)
    assert docs.count() > 0


#: The table and id of queries that return a row for each id.
ROW_OF = dict.fromkeys(QUERIES, ("documents", "doc_id")) | {
    "op5_lattice": ("embeddings", "vec_id"),
    "op10_warc": ("pages", "page_id"),
    "op13_repair": ("conversations", "conv_id"),
}


@pytest.mark.parametrize("name", [k for k in QUERIES if k not in ("pipeline", "op8_mix", "op11_collocations")])
def test_queries_return_a_row_for_each_row(spark, name):
    table, key = ROW_OF[name]
    ids = spark.read.parquet(f"{SF}/{table}.parquet").select(key).distinct()
    got = QUERIES[name](spark, SF)
    if name == "op9_section_tokens":  # a row for each line: every id, and each of its sections once
        sections = got.select(key, "section")
        assert sections.count() == sections.distinct().count()
        got = got.select(key).distinct()
    else:
        got = got.select(key)
    assert sorted(got.collect()) == sorted(ids.collect())


def test_queries_with_other_rows(spark):
    """op8 returns copies, op11 each language's phrases, ranked from 1."""
    assert QUERIES["op8_mix"](spark, SF).count() > 0
    ranks = {}
    for r in QUERIES["op11_collocations"](spark, SF).select("lang", "rank").collect():
        ranks.setdefault(r["lang"], []).append(r["rank"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) and len(v) <= 2000 for v in ranks.values())
