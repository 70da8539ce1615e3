"""Conversation repair against a search over all edits."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldlab.llm import repair as R

WHITE = " \t\n\x0b\x0c\r"


def brute(rows):
    """Cheapest edits of rows (role, text) in order by Dijkstra-like search over
    whole texts: every state keeps its least (cost, audit)."""
    seen, kinds, counts = set(), [], [0, 0, 0]
    for role, text in rows:
        body = text.strip(WHITE)
        fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else 3
        seen.add((role, text))
        kinds.append(fault)
        if fault < 3:
            counts[fault] += 1
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ())}

    def widen(best):
        for _ in range(3):
            for p, (c, t, out) in list(best.items()):
                for who in ("user", "assistant"):
                    q = step.get((p, who[0]))
                    if q:
                        new = (c + 3, t + "I", out + (who + ":",))
                        if q not in best or new[:2] < best[q][:2]:
                            best[q] = new
        return best

    # inserts that precede a row belong to it, so all texts of a state are compared at equal numbers of row edits
    for (role, text), fault in zip(rows, kinds):
        after = {}
        ways = []
        for p, (c, t, out) in best.items():
            state, k, more = p, 0, ()
            while k < 4:
                ways.append((state, c + 3 * k, t + "I" * k, out + more))
                who = "assistant" if state == "u" else "user"
                state, more, k = step[state, who[0]], more + (who + ":",), k + 1
        for p, c, t, out in ways:
            options = [(p, c + 4, t + "D", out)]
            if fault > 1:
                extra = 3 * (fault == 2)
                q = step.get((p, role[:1]))
                if q:
                    options.append((q, c + extra, t + "K", out + (f"{role}:{text}",)))
                for who in ("user", "assistant"):
                    q = step.get((p, who[0]))
                    if q:
                        options.append((q, c + 3 + extra, t + "R", out + (f"{who}:{text}",)))
            for q, cost, audit, lines in options:
                if q not in after or (cost, audit) < after[q][:2]:
                    after[q] = (cost, audit, lines)
        best = after
    best = widen(best)
    cost, audit, lines = min(best[q] for q in ("", "a") if q in best)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), "\n".join(lines)


def sample(rng, n_convs, longest=12):
    texts = ["Fine.", "Yes!", "Really?", "no end", "", "  ", "A. \n", "b", "c.", "d.", "e.", "Ä.", "x" * 50 + "."]
    out = []
    for c in range(n_convs):
        for t in range(rng.randrange(0, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            out.append((c, rng.choice([t, t, t, t + 1, None]), role, rng.choice([*texts, None])))
    return out


def expected(rows):
    """Results of rows (conv, turn, role, text) by conversation."""
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    return by


def check(got, rows, order_of_ties):
    by = expected(rows)
    for r in got:
        own = sorted(by.get(r["conv_id"], []), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), order_of_ties[x[2]]))
        turns = [x[0] for x in own if x[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts, illegal, cost, audit, sha, lines = brute([x[1:] for x in own])
        assert (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"]) == (gaps, *counts, illegal, cost), own
        assert (r["audit"], r["repaired_sha256"]) == (audit, sha), own
        if "repaired" in r:
            assert bytes(r["repaired"]).decode() == lines


def hashes(spark, rows):
    texts = sorted({" " if r[3] is None else r[3] for r in rows})
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h"))
    return {r["t"]: r["h"] for r in df.collect()}


def test_all_conversations_against_search(spark):
    rng = random.Random(3)
    rows = sample(rng, 400) + [(None, t, "user", "Q?") for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for c in ("ck", "part", "pos", "open", "cost", "audit"):
        df = df.withColumn(c, F.lit(1))
    got = [r.asDict() for r in R.repair(df, keep_text=True).collect()]
    assert len(got) == len({r[0] for r in rows})
    check(got, rows, hashes(spark, rows))


def test_conversations_spread_over_tasks_and_blocks(spark, monkeypatch):
    """Small limits: long conversations are open, in many blocks, hot or not."""
    monkeypatch.setattr(R, "LONG", 20)
    monkeypatch.setattr(R, "BLOCK", 7)
    monkeypatch.setattr(R, "LEAST_PAIRS", 2)
    rng = random.Random(5)
    rows = sample(rng, 30, 60)
    rows += [(1000, t, rng.choice(["user", "assistant"]), rng.choice(["same.", f"text {t}.", "cut"])) for t in range(500)]
    rows += [(2000, 1, "user", "Again.") for _ in range(90)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = [r.asDict() for r in R.repair(df, keep_text=True).collect()]
    assert len(got) == len({r[0] for r in rows})
    check(got, rows, hashes(spark, rows))


def test_empty_and_missing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert R.repair(empty).collect() == []
    every = spark.createDataFrame([(1,), (None,), (1,)], "conv_id long")
    got = R.repair(empty, every=every).collect()
    assert sorted((r["conv_id"] or 0, r["cost"], r["audit"], r["repaired_sha256"]) for r in got) == [(0, 0, "", hashlib.sha256(b"").hexdigest()), (1, 0, "", hashlib.sha256(b"").hexdigest())]


def test_invalid_bytes_and_long_text(spark):
    rows = [(1, 1, "user", "41FF2E"), (1, 2, "assistant", "42" * 300_000 + "2E")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, h string").withColumn("text", F.unhex("h").cast("string"))
    r = R.repair(df).first()
    assert (r["cost"], r["audit"]) == (0, "KK")
    assert r["repaired_sha256"] == hashlib.sha256(b"user:A\xff.\nassistant:" + b"B" * 300_000 + b".").hexdigest()


def test_grammar_equals_plain_products():
    """Compressed or not, every sequence has the same cost and edits."""
    rng = np.random.default_rng(1)
    lines = [rng.choice(9, size=rng.integers(0, 40), p=[0.05, 0.3, 0.3, 0.05, 0.02, 0.1, 0.1, 0.03, 0.05]) for _ in range(200)]
    lines += [np.full(33, 1), np.full(64, 8), np.tile([1, 2], 100)]
    plain = R.solve(R.Grammar(), lines)
    grammar = R.Grammar()
    short = R.compress(grammar, lines, least=2, most=300)
    assert len(grammar) > R.SYMBOLS + 50 and sum(map(len, short)) < sum(map(len, lines)) / 2
    assert R.solve(grammar, short) == plain
    for s, line in zip(short, lines):  # the rules spell the sequences
        flat, stack = [], list(s)[::-1]
        while stack:
            x = int(stack.pop())
            if x < R.SYMBOLS:
                flat.append(x)
            else:
                stack += [grammar.parts[x][1], grammar.parts[x][0]]
        assert flat == line.tolist()


@pytest.mark.parametrize("conv, turn", [("5", "7"), (" ", "7"), ("5", " ")])
def test_damage(spark, conv, turn):
    row = (None if conv == " " else int(conv), None if turn == " " else int(turn), None, "A. b! c?")
    kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
    got = [tuple(r) for r in R.damaged(spark.createDataFrame([row], "conv_id long, turn long, role string, text string")).collect()]
    text = {1: "", 2: "A b c"}.get(kind, "A. b! c?")
    assert got == [(row[0], row[1], "user" if kind == 4 else " ", text)] * {0: 0, 3: 2}.get(kind, 1)


def test_query_on_the_table(spark):
    """The query's every row, on the smallest table."""
    from yieldlab.llm.queries import op13_repair

    d = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = []
    for c, t, role, text in table:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        if kind:
            text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
            rows += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    got = [r.asDict() for r in op13_repair(spark, d).collect()]
    assert sorted(r["conv_id"] for r in got) == sorted({r[0] for r in table})
    check(got, rows, hashes(spark, rows))
