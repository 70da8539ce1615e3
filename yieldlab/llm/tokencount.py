"""Token counts of a document's sections by offset-mapped attribution.

A document is encoded once, as a whole. Its tokens' byte spans follow from the
tokens' lengths, as byte-level tokens tile the text. The spans are joined to
the sections' spans, both in order, by binary search. A token that crosses
from one section into another goes to one of them by an explicit rule:

``start``
    the section that has its first byte,
``most``
    the section that has most of its bytes, the first of several,
``shares``
    every section the share of the bytes that it has.

Sections are lines (a line break belongs to the line that it ends) or given
as spans of characters that don't overlap; tokens in no section are counted
as section -1.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_rows

RULES = ("start", "most", "shares")


def load(ranks: bytes, pattern: str):
    """A byte-level tokenizer of the lines ``base64 rank``, and the lengths of
    its tokens in bytes."""
    import base64

    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    sizes = np.zeros(max(table.values()) + 1, np.int64)
    for token, i in table.items():
        sizes[i] = len(token)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}), sizes


def line_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of lines in bytes; an empty text has no line."""
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    stops = np.append(breaks, len(data))
    starts = np.append(0, breaks)
    keep = starts < stops
    return starts[keep], stops[keep]


def attribute(sizes: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Of tokens of ``sizes`` bytes one behind another and sections in
    order: tokens of each section, tokens that cross into or out of it, and
    what belongs to no section."""
    n = len(starts)
    tokens, crossing = np.zeros(n + 1), np.zeros(n + 1, np.int64)
    if not len(sizes):
        return tokens[:n], crossing[:n], 0.0
    ends = np.cumsum(sizes)
    begins = ends - sizes
    # Cut the tokens at the sections' borders: each part lies in one section, or in none (n).
    borders = np.unique(np.concatenate([starts, stops]))
    low = np.searchsorted(borders, begins, side="right")
    inner = np.searchsorted(borders, ends, side="left") - low  # borders inside the token
    inner = np.maximum(inner, 0)
    token = np.repeat(np.arange(len(sizes)), inner + 1)
    nth = np.arange(len(token)) - np.repeat(np.cumsum(inner + 1) - inner - 1, inner + 1)
    cut = np.append(borders, 0)
    a = np.where(nth == 0, begins[token], cut[np.minimum(low[token] + nth - 1, len(borders))])
    b = np.where(nth == inner[token], ends[token], cut[np.minimum(low[token] + nth, len(borders))])
    section = np.searchsorted(starts, a, side="right") - 1
    section = np.where((section >= 0) & (a < np.append(stops, 0)[section]), section, n)
    crosses = inner[token] > 0
    np.add.at(crossing, section[crosses], 1)
    if rule == "shares":
        np.add.at(tokens, section, (b - a) / sizes[token])
    elif rule == "start":
        np.add.at(tokens, section[nth == 0], 1)
    else:
        order = np.lexsort((nth, -(b - a), token))
        most = order[np.r_[True, token[order][1:] != token[order][:-1]]]
        np.add.at(tokens, section[most], 1)
    return tokens[:n], crossing[:n], float(tokens[n])


def _count_task(batches: Iterator[pa.RecordBatch], ranks: bytes, pattern: str, rule: str, given: bool) -> Iterator[pa.RecordBatch]:
    tokenizer, sizes = load(ranks, pattern)
    names = ["id", "section", "start", "stop", "n_tokens", "n_crossing", "doc_tokens"]
    held, n = [], 0

    def flush() -> pa.RecordBatch:
        cols = [np.concatenate([h[j] for h in held]) for j in range(1, 7)]
        per = [len(h[1]) for h in held]
        ids = pa.array([h[0] for h in held], pa.int64()).take(pa.array(np.repeat(np.arange(len(held)), per)))
        return pa.record_batch([ids, *(pa.array(c) for c in cols)], names)

    for i, text, spans in text_rows(batches, "id", "text", "spans"):
        text = text or ""
        data = text.encode("utf-8")
        if given:
            # characters to bytes
            at = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
            own = sorted((max(s["start"], 0), min(s["stop"], len(text))) for s in spans or [] if s is not None and s["start"] is not None and s["stop"] is not None)
            own = [s for s in own if s[0] < s[1]]
            if any(p[1] > q[0] for p, q in zip(own, own[1:])):
                raise ValueError(f"sections of document {i} overlap")
            edge = np.array(own, np.int64).reshape(-1, 2)
            starts, stops = (np.searchsorted(at, edge[:, j] + 1, side="left") for j in (0, 1))
        else:
            starts, stops = line_spans(data)
        ids = tokenizer.encode_to_numpy(text, disallowed_special=()).astype(np.int64) if text else np.zeros(0, np.int64)
        tokens, crossing, rest = attribute(sizes[ids], starts, stops, rule)
        section = np.arange(len(starts))
        if rest or not len(starts):
            section, tokens, crossing = np.append(section, -1), np.append(tokens, rest), np.append(crossing, 0)
            starts, stops = np.append(starts, 0), np.append(stops, 0)
        held.append((i, section.astype(np.int32), starts.astype(np.int64), stops.astype(np.int64), tokens, crossing.astype(np.int64), np.full(len(section), len(ids))))
        n += len(section)
        if n > 20_000:
            yield flush()
            held, n = [], 0
    if held:
        yield flush()


def section_tokens(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", sections_col: str | None = None, rule: str = "start") -> DataFrame:
    """``(id_col, section, start_byte, stop_byte, n_tokens double, n_crossing,
    doc_tokens)``, a row for each section of each row of ``docs``.

    The tokens of a document's sections add up to ``doc_tokens``; what belongs
    to none is section -1, which a null or empty text has alone, with 0
    tokens. Rows that repeat an id, or have none, each count by themselves.
    Special tokens' strings are ordinary text. ``sections_col`` is an array of
    structs (start, stop) in characters, cut to the text; null or empty spans
    don't count, and overlapping ones raise. Other columns are ignored."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {', '.join(RULES)}")
    small_batches(docs.sparkSession)
    spans = F.col(sections_col).cast("array<struct<start:long,stop:long>>") if sections_col else F.lit(None).cast("array<struct<start:long,stop:long>>")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), spans.alias("spans"))
    kind = "id long, section int, start long, stop long, n_tokens double, n_crossing long, doc_tokens long"
    out = src.mapInArrow(partial(_count_task, ranks=ranks, pattern=pattern, rule=rule, given=bool(sections_col)), kind)
    return out.select(F.col("id").alias(id_col), "section", F.col("start").alias("start_byte"), F.col("stop").alias("stop_byte"), "n_tokens", "n_crossing", "doc_tokens")
