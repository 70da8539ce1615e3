"""Conversation structure repair by dynamic programming on a grammar.

A conversation's rows become symbols: the role's initial, and whether the row
must go (blank, or a duplicate) or is truncated. The cheapest edits that give
role initials ``(s?(ua)+)?`` are a shortest path through four states (start,
after s, after u, after a), so each row is a min-plus matrix from state to
state, and a stretch of rows the product of theirs. Re-Pair replaces the most
frequent pair of adjacent symbols by a new one, again and again; each such
rule's matrix is made once, from its two parts, and serves every conversation
in which the pair occurs.

An entry is a cost, and the edits as a rope: which state lies between the two
parts. Ties go to the least text, without looking at texts: inserts are counted
to the row that they precede, so all texts of a stretch end with a row's edit
and none begins another. Of two entries from one state, the order of the left
parts decides, then that of the right parts; a rank in each row of the matrix
carries it on.

Rows are range-partitioned and sorted by conversation and turn, so that a large
conversation is spread over tasks. A task settles the conversations that begin
and end inside it; the others (two a task, and any of over ``LONG`` rows) are
cut into blocks: the blocks' matrices are made in parallel, their chain is
folded with a few bytes a block, and rows are hashed one after the other, as
SHA-256 asks for, in bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, partitions, small_batches, text_rows

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: State after a role with the initial s, u, a or another, from start, s, u, a.
AFTER = [[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]]
#: The state after an inserted row, and the role that it must have.
NEXT, ROLE = [2, 2, 3, 2], [b"user", b"user", b"assistant", b"user"]
#: Rows to insert at the end to be in an accepted state.
TAIL = [0, 2, 1, 0]
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Symbols: 0 to 3 the initial, 4 to 7 the same truncated, 8 a row that must go.
GONE, SYMBOLS = 8, 9
FAR = 1 << 40

#: A pair seen less often is no rule, and so many rules are made at most.
LEAST_PAIRS, MOST_RULES = 16, 600
#: Rows of a conversation that one task settles, rows of a block, rows and bytes settled together.
LONG, BLOCK, CHUNK_ROWS, CHUNK_BYTES = 20_000, 2048, 50_000, 16 << 20


def _row_matrix(symbol: int) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Costs, ranks and edits of one row, with the inserts before it."""
    best: list[list[tuple[int, str]]] = [[(FAR, "")] * 4 for _ in range(4)]
    for p in range(4):
        state = p
        for inserts in range(3):
            ways = [(state, DELETE, "D")]
            if symbol != GONE:
                extra = TRUNCATED if symbol >= 4 else 0
                ways += [(AFTER[state][symbol % 4], KEEP + extra, "K"), (NEXT[state], REROLE + extra, "R")]
            for q, cost, edit in ways:
                if q >= 0:
                    best[p][q] = min(best[p][q], (INSERT * inserts + cost, "I" * inserts + edit))
            state = NEXT[state]
    cost = np.array([[c for c, _ in row] for row in best], np.int64)
    rank = np.full((4, 4), 9, np.int64)
    for p in range(4):
        for k, q in enumerate(sorted((q for q in range(4) if best[p][q][0] < FAR), key=lambda q: best[p][q][1])):
            rank[p, q] = k
    return cost, rank, [[e for _, e in row] for row in best]


class Grammar:
    """Matrices of the symbols, and of the rules added to them."""

    def __init__(self):
        rows = [_row_matrix(s) for s in range(SYMBOLS)]
        self.cost = [r[0] for r in rows]
        self.rank = [r[1] for r in rows]
        self.choice: list[np.ndarray | None] = [None] * SYMBOLS
        self.parts: list[tuple[int, int]] = [(-1, -1)] * SYMBOLS
        self.texts: dict[tuple[int, int, int], str] = {(s, p, q): rows[s][2][p][q] for s in range(SYMBOLS) for p in range(4) for q in range(4)}

    def __len__(self) -> int:
        return len(self.cost)

    def add(self, left: int, right: int) -> int:
        """The symbol of ``left`` followed by ``right``."""
        ca, ra, cb, rb = self.cost[left], self.rank[left], self.cost[right], self.rank[right]
        total = ca[:, :, None] + cb[None, :, :]
        mid = (total * 16 + ra[:, :, None]).argmin(axis=1)
        p, q = np.arange(4)[:, None], np.arange(4)[None, :]
        cost = np.minimum(total[p, mid, q], FAR)
        order = np.where(cost < FAR, ra[p, mid] * 16 + rb[mid, q], 1000)
        rank = np.where(cost < FAR, order.argsort(axis=1, kind="stable").argsort(axis=1, kind="stable"), 9)
        self.cost.append(cost)
        self.rank.append(rank)
        self.choice.append(mid)
        self.parts.append((left, right))
        return len(self.cost) - 1

    def text(self, symbol: int, p: int, q: int) -> str:
        """The edits of an entry: its rope, read out and remembered."""
        stack, texts = [(symbol, p, q)], self.texts
        while stack:
            node = stack[-1]
            if node in texts:
                stack.pop()
                continue
            s, a, b = node
            (left, right), mid = self.parts[s], int(self.choice[s][a, b])
            x, y = (left, a, mid), (right, mid, b)
            if x in texts and y in texts:
                texts[node] = texts[x] + texts[y]
                stack.pop()
            else:
                stack += [n for n in (x, y) if n not in texts]
        return texts[symbol, p, q]

    def forget(self, size: int) -> None:
        """Drop the rules from number ``size`` on."""
        for rows in (self.cost, self.rank, self.choice, self.parts):
            del rows[size:]
        for key in [k for k in self.texts if k[0] >= size]:
            del self.texts[key]


def compress(grammar: Grammar, sequences: list[np.ndarray], least: int = LEAST_PAIRS, most: int = MOST_RULES) -> list[np.ndarray]:
    """The sequences in the grammar's rules, those it gets here included: while
    a pair of adjacent symbols occurs ``least`` times, the most frequent one
    becomes a rule."""
    if not sequences:
        return []
    lengths = np.array([len(s) for s in sequences])
    x = np.full(lengths.sum() + len(sequences), -1, np.int64)  # -1 between sequences
    inside = np.ones(len(x), bool)
    inside[np.cumsum(lengths + 1) - 1] = False
    x[inside] = np.concatenate(sequences) if lengths.sum() else []
    first = len(grammar)
    while len(grammar) - first < most:
        k = len(grammar)
        pair = x[:-1] * k + x[1:]
        pair[(x[:-1] < 0) | (x[1:] < 0)] = k * k
        counts = np.bincount(pair, minlength=k * k + 1)[: k * k] if len(pair) else np.zeros(1, np.int64)
        top = int(counts.argmax())
        if counts[top] < least:
            break
        at = np.flatnonzero(pair == top)
        if top // k == top % k:  # in a run of one symbol every second place, from its start
            fresh = np.flatnonzero(np.diff(at, prepend=-9) != 1)
            at = at[(np.arange(len(at)) - np.repeat(fresh, np.diff(np.append(fresh, len(at))))) % 2 == 0]
        x[at] = grammar.add(top // k, top % k)
        x = np.delete(x, at + 1)
    ends = np.flatnonzero(x < 0)
    starts = np.append(0, ends[:-1] + 1)
    return [x[a:b] for a, b in zip(starts, ends)]


def solve(grammar: Grammar, sequences: list[np.ndarray]) -> list[tuple[int, str]]:
    """Cost and edits of each sequence of symbols, from start to acceptance;
    all sequences go on by one symbol at a time."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    cost_of, rank_of = np.array(grammar.cost), np.array(grammar.rank)
    n = len(sequences)
    cost, rank = np.full((n, 4), FAR, np.int64), np.tile(np.arange(4), (n, 1))
    cost[:, 0] = 0
    padded = np.zeros((n, int(lengths.max(initial=0))), np.int64)
    for k, i in enumerate(order):
        padded[k, : lengths[i]] = sequences[i]
    q = np.arange(4)[None, :]
    back = []
    for j in range(padded.shape[1]):
        live = int(np.searchsorted(-lengths[order], -j, side="left"))
        symbols, rows = padded[:live, j], np.arange(live)[:, None]
        total = cost[:live, :, None] + cost_of[symbols]
        mid = (total * 16 + rank[:live, :, None]).argmin(axis=1)
        now = np.minimum(total[rows, mid, q], FAR)
        key = np.where(now < FAR, rank[rows, mid] * 16 + rank_of[symbols][rows, mid, q], 1000)
        cost[:live], rank[:live] = now, key.argsort(axis=1, kind="stable").argsort(axis=1, kind="stable")
        back.append(mid)
    total = cost + INSERT * np.array(TAIL)
    last = (total * 16 + rank).argmin(axis=1)
    out: list[tuple[int, str]] = [(0, "")] * n
    for k, i in enumerate(order):
        state, texts = int(last[k]), ["I" * TAIL[last[k]]]
        for j in range(lengths[i] - 1, -1, -1):
            before = int(back[j][k, state])
            texts.append(grammar.text(int(padded[k, j]), before, state))
            state = before
        out[i] = (int(total[k, last[k]]), "".join(reversed(texts)))
    return out


def edited(rows: Iterator[tuple[bytes, bytes]], edits: str, state: int = 0) -> Iterator[tuple[bytes, bytes]]:
    """The repaired rows ``(role, text)`` of ``rows`` by their edits."""
    rows = iter(rows)
    for e in edits:
        role, text = (b"", b"") if e == "I" else next(rows)
        if e == "D":
            continue
        if e == "K":
            state = AFTER[state]["sua".index(chr(role[0]))]
        else:
            role, state = ROLE[state], NEXT[state]
        yield role, text


def _faults(rows: list[tuple]) -> tuple[np.ndarray, list[int]]:
    """Symbols of a conversation's rows ``(turn, role, text, initial, flags)``
    and the numbers of blank, duplicate and truncated ones."""
    seen, counts, out = set(), [0, 0, 0], np.empty(len(rows), np.int64)
    for i, (_, role, text, initial, flags) in enumerate(rows):
        again = (role, text) in seen
        seen.add((role, text))
        fault = 0 if flags & 1 else 1 if again else 2 if flags & 2 else -1
        if fault >= 0:
            counts[fault] += 1
        out[i] = GONE if fault in (0, 1) else initial + 4 * (fault == 2)
    return out, counts


def _turns(turns: list) -> tuple:
    """Least, greatest and number of distinct ones of sorted turns."""
    known = [t for t in turns if t is not None]
    return (known[0], known[-1], 1 + sum(a != b for a, b in zip(known, known[1:]))) if known else (None, None, 0)


def _illegal(initials: list[int]) -> int:
    return sum(p not in LEGAL for p in zip(initials, initials[1:]))


RESULT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()), ("repaired", pa.binary())]
ROW = [("part", pa.int32()), ("pos", pa.int64()), ("turn", pa.int64()), ("role", pa.binary()), ("text", pa.binary()), ("initial", pa.int32()), ("flags", pa.int32())]
SETTLED = pa.schema([("ck", pa.string()), ("open", pa.bool_()), *RESULT, *ROW])


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)


def _settle(keep_text: bool):
    """Sorted rows of a range partition -> a result for each conversation that
    lies inside it, and the rows of the others."""

    def finish(convs: list[tuple[str, list[tuple]]], known: dict) -> pa.RecordBatch:
        found = [_faults(rows) for _, rows in convs]
        new = {s.tobytes(): s for s, _ in found if s.tobytes() not in known}
        if len(known) + len(new) > 200_000:
            known.clear()
            new = {s.tobytes(): s for s, _ in found}
        grammar = Grammar()
        known.update(zip(new, solve(grammar, compress(grammar, list(new.values()))) if new else []))
        out = []
        for (key, rows), (symbols, counts) in zip(convs, found):
            cost, audit = known[symbols.tobytes()]
            low, high, distinct = _turns([r[0] for r in rows])
            text = b"\n".join(role + b":" + t for role, t in edited(((r[1], r[2]) for r in rows), audit))
            out.append((key, False, 0 if low is None else high - low + 1 - distinct, *counts, _illegal([r[3] for r in rows]), cost, audit, hashlib.sha256(text).hexdigest(), text if keep_text else None, *[None] * len(ROW)))
        return _table(SETTLED, out)

    def passed(key: str, rows: list[tuple], pos: int) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(rows), 512):
            yield _table(SETTLED, [(key, True, *[None] * len(RESULT), part, pos + at + i, t, role, text, initial, flags) for i, (t, role, text, initial, flags, part) in enumerate(rows[at : at + 512])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        ready: list[tuple[str, list[tuple]]] = []
        now, rows, is_open, pos, n_rows, n_bytes = None, [], True, 0, 0, 0
        for key, *row in text_rows(batches, "ck", "turn", "role", "text", "initial", "flags", "part"):
            if key != now:
                if now is not None:
                    if is_open:  # the first one, or a long one
                        yield from passed(now, rows, pos)
                        pos += len(rows)
                    else:
                        ready.append((now, [r[:5] for r in rows]))
                        n_rows, n_bytes = n_rows + len(rows), n_bytes + sum(len(r[2]) for r in rows)
                    is_open = False
                now, rows = key, []
                if n_rows >= CHUNK_ROWS or n_bytes >= CHUNK_BYTES:
                    yield finish(ready, known)
                    ready, n_rows, n_bytes = [], 0, 0
            rows.append(tuple(row))
            if len(rows) >= (512 if is_open else LONG):
                is_open = True
                yield from passed(now, rows, pos)
                pos, rows = pos + len(rows), []
        if ready:
            yield finish(ready, known)
        if now is not None:  # the last one may go on in the next partition
            yield from passed(now, rows, pos)

    return run


LINK = [("part", pa.int32()), ("block", pa.int64())]
MATRIX = pa.schema([
    ("ck", pa.string()), *LINK, ("cost", pa.list_(pa.int64())), ("rank", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
    ("low", pa.int64()), ("high", pa.int64()), ("distinct", pa.int64()),
])
CHAIN = pa.schema([("ck", pa.string()), *LINK, ("entry", pa.int32()), ("state", pa.int32()), *RESULT[:6], ("tail", pa.int32())])


def _block_matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of symbols -> their matrices, all edits spelt out."""
    for batch in batches:
        rows = batch.to_pylist()
        grammar = Grammar()
        lines = compress(grammar, [np.array([c["symbol"] for c in r["cells"]], np.int64) for r in rows])
        size, out = len(grammar), []
        for r, line in zip(rows, lines):
            line = list(line)
            while len(line) > 1:
                line = [grammar.add(*line[i : i + 2]) if i + 1 < len(line) else line[i] for i in range(0, len(line), 2)]
            cost, rank = grammar.cost[line[0]], grammar.rank[line[0]]
            audits = [grammar.text(line[0], p, q) if cost[p, q] < FAR else None for p in range(4) for q in range(4)]
            grammar.forget(size)
            initials = [c["initial"] for c in r["cells"]]
            out.append((r["ck"], r["part"], r["block"], cost.ravel().tolist(), rank.ravel().tolist(), audits, r["blank"], r["duplicate"], r["truncated"], _illegal(initials), initials[0], initials[-1], *_turns([c["turn"] for c in r["cells"]])))
        if out:
            yield _table(MATRIX, out)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matrices of each conversation's blocks, in order -> the entry of each
    block on the cheapest path, and the conversation's figures at its last."""

    def close(key: str, links: list, back: list, cost: np.ndarray, rank: np.ndarray, sums: list) -> pa.RecordBatch:
        total = cost + INSERT * np.array(TAIL)
        state = int((total * 16 + rank).argmin())
        gaps = 0 if sums[5] is None else sums[6] - sums[5] + 1 - sums[7]
        out = [None] * len(links)
        for i in range(len(links) - 1, -1, -1):
            before = int(back[i][state])
            figures = (gaps, *sums[:4], int(total[state]), TAIL[state]) if i == len(links) - 1 else (None,) * 7
            out[i] = (key, *links[i], before * 4 + state, before, *figures)
            state = before
        return _table(CHAIN, out)

    now = None
    for batch in batches:
        for r in batch.to_pylist():
            if r["ck"] != now:
                if now is not None:
                    yield close(now, links, back, cost, rank, sums)
                now, links, back = r["ck"], [], []
                cost, rank = np.array([0, FAR, FAR, FAR]), np.arange(4)
                # blank, duplicate, truncated, illegal, last initial, least, greatest and distinct turns
                sums = [0, 0, 0, 0, None, None, None, 0]
            c, k = np.array(r["cost"]).reshape(4, 4), np.array(r["rank"]).reshape(4, 4)
            total = cost[:, None] + c
            mid = (total * 16 + rank[:, None]).argmin(axis=0)
            cost = np.minimum(total[mid, np.arange(4)], FAR)
            key = np.where(cost < FAR, rank[mid] * 16 + k[mid, np.arange(4)], 1000)
            rank = key.argsort(kind="stable").argsort(kind="stable")
            links.append((r["part"], r["block"]))
            back.append(mid.astype(np.int8))
            for i, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
                sums[i] += r[name]
            sums[3] += sums[4] is not None and (sums[4], r["first"]) not in LEGAL
            sums[4] = r["last"]
            if r["low"] is not None:
                sums[7] += r["distinct"] - (sums[6] == r["low"])
                sums[5], sums[6] = r["low"] if sums[5] is None else sums[5], r["high"]
    if now is not None:
        yield close(now, links, back, cost, rank, sums)


def _hash(keep_text: bool, schema: pa.Schema):
    """A conversation's blocks of edits, each followed by its rows, in order ->
    its result."""

    class Open:
        def __init__(self, key: str):
            self.key, self.digest, self.begun, self.audit, self.lines = key, hashlib.sha256(), False, [], []
            self.figures, self.left, self.state = None, iter(""), 0

        def put(self, role: bytes, text: bytes) -> None:
            line = role + b":" + text
            self.digest.update(b"\n" + line if self.begun else line)
            self.begun = True
            if keep_text:
                self.lines.append(line)

        def block(self, edits: str, state: int, figures: list, tail: int | None) -> None:
            if tail is not None:  # the last block
                self.figures, edits = figures, edits + "I" * tail
            self.audit.append(edits)
            self.left, self.state = iter(edits), state

        def inserts(self) -> str | None:
            """Put the rows inserted here; the next edit of another kind."""
            for e in self.left:
                if e != "I":
                    return e
                self.put(ROLE[self.state], b"")
                self.state = NEXT[self.state]
            return None

        def row(self, role: bytes, text: bytes) -> None:
            edit = self.inserts()
            if edit == "K":
                self.state = AFTER[self.state]["sua".index(chr(role[0]))]
                self.put(role, text)
            elif edit == "R":
                self.put(ROLE[self.state], text)
                self.state = NEXT[self.state]

        def close(self) -> pa.RecordBatch:
            self.inserts()
            text = b"\n".join(self.lines) if keep_text else None
            return _table(schema, [(self.key, *self.figures, "".join(self.audit), self.digest.hexdigest(), text)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        names = ("ck", "edits", "state", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "tail", "role", "text")
        for key, edits, state, *figures, tail, role, text in text_rows(batches, *names):
            if now is None or key != now.key:
                if now is not None:
                    yield now.close()
                now = Open(key)
            if edits is not None:
                now.block(edits, state, figures, tail)
            else:
                now.row(role, text)
        if now is not None:
            yield now.close()

    return run


def _ddl(schema: pa.Schema) -> T.StructType:
    from pyspark.sql.pandas.types import from_arrow_schema

    return from_arrow_schema(schema)


def _key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("null"))


def repair(
    rows: DataFrame, every: DataFrame | None = None, keep_text: bool = False,
    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row for each conversation of ``every`` (or ``rows``): its id,
    ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``
    (longs), ``audit`` (the cheapest edits K, R, D, I in order, the ASCII-least
    of them) and ``repaired_sha256``; with ``keep_text`` also ``repaired``, the
    lines ``role:text`` themselves (bytes).

    Conversations of null id are one; null roles and texts are one space; a row
    whose role is empty or has another initial than s, u, a can't be kept. Rows
    go by turn (nulls first), those of one turn by role, then by a hash of the
    text. Repeated rows are duplicates. A conversation of ``every`` without
    rows gets zeros, no edits and the hash of nothing. Other columns aren't
    read, whatever their names."""
    spark = rows.sparkSession
    small_batches(spark)
    n = partitions(spark)
    role, text = F.coalesce(F.col(role_col), F.lit(" ")), F.coalesce(F.col(text_col), F.lit(" "))
    initial = F.substring(role, 1, 1)
    plain = rows.select(
        _key(F.col(conv_col)).alias("ck"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"),
        F.when(~text.rlike(r"[^\x20\x09-\x0D]"), 1).when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), 2).otherwise(0).alias("flags"),
        F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("at"),
    )
    order = ["ck", "turn", "role", "hash", "at"]
    ranged = plain.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = ranged.select("ck", "turn", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), "initial", "flags", F.spark_partition_id().alias("part"))
    settled = materialize(ranged.mapInArrow(_settle(keep_text), _ddl(SETTLED)), "settled")
    names = [c for c, _ in RESULT]
    done = settled.filter("not open").select("ck", *names).unionByName(_repair_open(settled.filter("open").select("ck", *[c for c, _ in ROW]), n, keep_text))
    ids = (rows if every is None else every).select(F.col(conv_col).alias("conv")).distinct().withColumn("key", _key(F.col("conv")))
    out = ids.join(done, ids["key"] == done["ck"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("conv").alias(conv_col), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in names[:6]],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
        *([F.coalesce("repaired", F.lit(b"")).alias("repaired")] if keep_text else []),
    )


def _repair_open(rows: DataFrame, n: int, keep_text: bool) -> DataFrame:
    """The same for rows ``(ck, part, pos, ...)`` of conversations that lie in
    several partitions, or may."""
    block = F.floor(F.col("pos") / BLOCK).cast("long")
    light = rows.select("ck", "part", "pos", "turn", "role", F.sha2("text", 256).alias("hash"), "initial", "flags")
    first = light.groupBy("ck", "role", "hash").agg(F.min(F.struct("part", "pos")).alias("first"))
    again = F.struct("part", "pos") > F.col("first")
    fault = F.when(F.col("flags") == 1, 0).when(again, 1).when(F.col("flags") == 2, 2).otherwise(3)
    cells = light.join(first, ["ck", "role", "hash"]).withColumn("fault", fault).withColumn(
        "symbol", F.when(F.col("fault") < 2, GONE).when(F.col("fault") == 2, F.col("initial") + 4).otherwise(F.col("initial"))
    )
    blocks = cells.groupBy("ck", "part", block.alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "symbol", "initial", "turn"))).alias("cells"),
        *[F.count_if(F.col("fault") == k).alias(c) for k, c in enumerate(("blank", "duplicate", "truncated"))],
    )
    matrices = materialize(blocks.mapInArrow(_block_matrices, _ddl(MATRIX)), "matrices")
    chain = matrices.drop("audits").repartition(n, "ck").sortWithinPartitions("ck", "part", "block").mapInArrow(_chain, _ddl(CHAIN))
    edits = chain.join(matrices.select("ck", "part", "block", "audits"), ["ck", "part", "block"])
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "tail"]
    heads = edits.select("ck", "part", "block", F.lit(-1).cast("long").alias("pos"), F.get("audits", F.col("entry")).alias("edits"), "state", *figures, F.lit(None).cast("binary").alias("role"), F.lit(None).cast("binary").alias("text"))
    lines = rows.select("ck", "part", block.alias("block"), "pos", "role", "text")
    every = heads.unionByName(lines, allowMissingColumns=True).repartition(n, "ck").sortWithinPartitions("ck", "part", "block", "pos")
    schema = pa.schema([("ck", pa.string()), *RESULT])
    return every.mapInArrow(_hash(keep_text, schema), _ddl(schema))


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with planted faults, by the CRC-32 of ``conv_id:turn``
    modulo 20: 0 drops a row, 1 empties its text, 2 takes ``[.!?]`` out, 3
    repeats it, 4 makes it a user's. Nulls are one space, but for ids and
    turns, which stay null."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = (F.crc32(key.cast("binary")) % 20).alias("kind")
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")
