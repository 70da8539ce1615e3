"""SentencePiece (BPE) encoding and decoding by vectorised merge rounds.

A text becomes words that no merge can cross: each run of meta spaces with
the letters behind it, cut again around every character that is in no longer
piece. The words that a task hasn't met before are encoded together in flat
arrays of symbols: a round finds each word's best pair (the smallest rank of
the merged piece), merges its occurrences from the left, all at once, and
compacts the arrays; words without a pair left drop out. A text is then its
words' ids one after another.

Where a merged piece could take part in a better merge than its own (a rank
better than that of a part, or ranks that tie), only the leftmost occurrence
is merged in a round, as the library's queue would. Rounds over a long word
would then cost the square of its length, so that a word of more than
``LONG`` characters (a table's run of spaces, a line of one letter) is merged
by itself, best pair first, with a heap of its pairs.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, text_rows

SPACE = "▁"
CACHE_WORDS, CACHE_CHARS = 400_000, 64
LONG = 256
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
NEVER = np.iinfo(np.int32).max


class Vocabulary:
    """The tables of a BPE model with byte fallback, no character map and no
    user-defined pieces."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        norm = proto.normalizer_spec
        kinds = [p.type for p in proto.pieces]
        if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or {USER, UNUSED} & set(kinds) or not proto.trainer_spec.byte_fallback or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("a BPE model with byte fallback and identity normalisation is needed")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = np.array(kinds)
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.bytes = np.array([next(i for i, p in enumerate(self.pieces) if p == f"<0x{b:02X}>" and kinds[i] == BYTE) for b in range(256)])
        self.byte_of = {int(i): b for b, i in enumerate(self.bytes)}
        scores = {i: proto.pieces[i].score for i in self.ids.values()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        rank = {i: order[s] for i, s in scores.items()}
        long_ = [p for p in self.ids if len(p) > 1]
        #: Characters that occur in pieces of more than one character.
        self.joins = frozenset("".join(long_))
        if any(SPACE in p.lstrip(SPACE) for p in long_):
            raise ValueError("a piece has a space behind a letter")
        # Every way to put a piece together from two pieces or characters that may stand as symbols.
        left, right, made = [], [], []
        for p in long_:
            for cut in range(1, len(p)):
                a, b = self.ids.get(p[:cut]), self.ids.get(p[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(self.ids[p])
        left, right, made = (np.array(x, np.int64) for x in (left, right, made))
        key = left << 32 | right
        by = np.argsort(key)
        self.keys, self.made = key[by], made[by]
        ranks = np.full(len(self.pieces), NEVER, np.int32)
        ranks[list(rank)] = list(rank.values())
        self.rank = ranks
        shared = np.bincount(ranks[ranks < NEVER], minlength=1) > 1
        early = np.zeros(len(self.pieces), bool)  # parts of pieces that are no worse than they
        for part in (left, right):
            inner = np.array([len(self.pieces[i]) > 1 for i in part], bool)
            early[part[inner & (ranks[made] <= ranks[part])]] = True
        self.lone = early | (np.isin(ranks, np.flatnonzero(shared)) & (ranks < NEVER))
        #: What a piece reads as behind others, if it says so by itself.
        self.reads = [p.replace(SPACE, " ") if k == NORMAL else None for p, k in zip(self.pieces, kinds)]
        letters = re.escape("".join(sorted(self.joins - {SPACE})))
        # a run of spaces with what joins it; a run that follows something else; one character that joins nothing
        self.split = re.compile(f"{SPACE}+[{letters}]*|[{letters}]+|[^{letters}{SPACE}]", re.S)

    def merged(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and rank of each pair of neighbours (rank NEVER: no piece)."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        piece = np.where(ok, self.made[at], -1)
        return piece, np.where(ok, self.rank[piece], NEVER)

    @cached_property
    def made_of(self) -> dict[int, int]:
        """Pair -> piece, for one look-up at a time."""
        return dict(zip(self.keys.tolist(), self.made.tolist()))


def encode_long(vocab: Vocabulary, word: str) -> list[int]:
    """Ids of one word by a heap of (rank, place): about n log n steps."""
    points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, which = np.unique(points, return_inverse=True)
    start = np.array([vocab.ids.get(chr(c), -1 - int(c)) for c in kinds], np.int64)[which]
    n, made_of, rank_of = len(start), vocab.made_of, vocab.rank.tolist()
    _, first = vocab.merged(start[:-1], start[1:])
    at = np.flatnonzero(first < NEVER)
    # rank and place in one number; a place's entry counts while its pair still has that rank
    heap = (first[at].astype(np.int64) << 32 | at).tolist()
    heapq.heapify(heap)
    now = [*first.tolist(), NEVER]
    sym, after, before = start.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))

    def look(i: int, j: int) -> None:
        """The pair of the symbols at ``i`` and, behind it, ``j``."""
        piece = made_of.get(sym[i] << 32 | sym[j]) if sym[i] >= 0 and sym[j] >= 0 else None
        if piece is None:
            now[i] = NEVER
        else:
            now[i] = rank_of[piece]
            heapq.heappush(heap, now[i] << 32 | i)

    while heap:
        top = heapq.heappop(heap)
        i = top & 0xFFFFFFFF
        if now[i] != top >> 32:
            continue
        j = after[i]
        sym[i] = made_of[sym[i] << 32 | sym[j]]
        now[j] = NEVER  # j is no symbol any more
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            look(i, k)
        else:
            now[i] = NEVER
        if before[i] >= 0:
            look(before[i], i)
    out, i = [], 0
    while i < n:
        if sym[i] >= 0:
            out.append(sym[i])
        else:
            out.extend(vocab.bytes[list(chr(-1 - sym[i]).encode("utf-8", "surrogatepass"))].tolist())
        i = after[i]
    return out


def encode_words(vocab: Vocabulary, words: list[str]) -> list[list[int]]:
    """Ids of words that no merge crosses, all in flat arrays but the long."""
    if any(len(w) > LONG for w in words):
        rest = iter(encode_words(vocab, [w for w in words if len(w) <= LONG]))
        return [encode_long(vocab, w) if len(w) > LONG else next(rest) for w in words]
    lengths = np.array([len(w) for w in words], np.int64)
    text = "".join(words)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, which = np.unique(points, return_inverse=True)
    # characters without a piece of their own: -1 less their code point
    table = np.array([vocab.ids.get(chr(c), -1 - int(c)) for c in kinds], np.int64)
    sym = table[which] if len(points) else np.zeros(0, np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    out: list = [None] * len(words)

    def finish(sym: np.ndarray, word: np.ndarray) -> None:
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        raw = np.minimum.reduceat(sym, starts) < 0
        ids, stops = sym.tolist(), [*starts[1:].tolist(), len(sym)]
        for w, a, b, r in zip(word[starts].tolist(), starts.tolist(), stops, raw.tolist()):
            own = ids[a:b]
            if r:
                own = [j for i in own for j in ([i] if i >= 0 else vocab.bytes[list(chr(-1 - i).encode("utf-8", "surrogatepass"))].tolist())]
            out[w] = own

    def pairs(left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and rank of the symbols at ``left`` with those behind them."""
        right = np.minimum(left + 1, len(sym) - 1)
        made, rank = vocab.merged(sym[left], sym[right])
        return made, np.where((word[left] == word[right]) & (right > left), rank, NEVER)

    if len(sym):
        piece, rank = pairs(np.arange(len(sym)))
    while len(sym):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        size = np.diff(np.r_[starts, len(sym)])
        best = np.minimum.reduceat(rank, starts)
        done = best == NEVER
        if done.any():
            rest = np.repeat(~done, size)
            finish(sym[~rest], word[~rest])
            sym, word, piece, rank = sym[rest], word[rest], piece[rest], rank[rest]
            best, size = best[~done], size[~done]
            if not len(sym):
                break
        at = np.flatnonzero(rank == np.repeat(best, size))
        # Of one word: the leftmost only where it must be, else every other one of a run of overlapping pairs.
        first = np.r_[True, word[at[1:]] != word[at[:-1]]]
        lone = vocab.lone[piece[at[first]]][np.cumsum(first) - 1]
        run = np.r_[True, at[1:] != at[:-1] + 1] | first
        place = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
        at = at[np.where(lone, first, place % 2 == 0)]
        sym[at] = piece[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        at = np.cumsum(keep)[at] - 1
        sym, word, piece, rank = sym[keep], word[keep], piece[keep], rank[keep]
        # only the pairs on both sides of a merged one have changed
        new = np.unique(np.concatenate([np.maximum(at - 1, 0), at]))
        piece[new], rank[new] = pairs(new)
    return [x if x is not None else [] for x in out]


class Encoder:
    """Encodes texts, remembering words; the memory is bounded."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.known = vocab, {}

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        return self.vocab.split.findall(self.vocab.prefix + text.replace(" ", SPACE))

    def encode(self, texts: list[str], join) -> Iterator[list]:
        """For each text its words' ``join(ids)`` in order."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        split = [self.words(t) for t in texts]
        new = list(set().union(*split) - self.known.keys()) if split else []
        own = dict(zip(new, map(join, encode_words(self.vocab, new))))
        long_ = {w: own.pop(w) for w in new if len(w) > CACHE_CHARS}
        self.known.update(own)
        get = self.known.__getitem__
        for words in split:
            try:
                yield list(map(get, words))
            except KeyError:
                yield [long_[w] if w in long_ else get(w) for w in words]


def decode_ids(vocab: Vocabulary, ids: list[int]) -> str:
    """The text of ids as the library decodes them: the dummy prefix dropped,
    bytes joined, and every byte that is in no character replaced."""
    out, raw = [], bytearray()
    first = True

    def flush() -> None:
        at = 0
        while at < len(raw):  # one replacement for each byte outside a character
            for n in (1, 2, 3, 4):
                try:
                    out.append(bytes(raw[at : at + n]).decode("utf-8"))
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        raw.clear()

    for i in ids:
        kind = vocab.kinds[i]
        if kind == BYTE:
            raw.append(vocab.byte_of[i])
            first = False
            continue
        flush()
        if kind == CONTROL:
            continue
        if kind == UNKNOWN:
            out.append(" ⁇ ")
            first = False
            continue
        piece = vocab.pieces[i]
        if first and vocab.prefix and piece.startswith(SPACE):
            piece = piece[1:]
        first = False
        out.append(piece.replace(SPACE, " "))
    flush()
    return "".join(out)


def _digest_task(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    """Ids go as decimal strings of words, so that a text's are one join."""
    vocab = Vocabulary(model)
    encoder = Encoder(vocab)

    decimal, reads = [str(i) for i in range(len(vocab.pieces))], vocab.reads

    def join(ids: list[int]) -> tuple[str, int, str]:
        try:
            text = "".join([reads[i] for i in ids])
        except TypeError:  # bytes; behind a letter nothing is dropped, as within a text
            text = decode_ids(vocab, [vocab.ids["a"], *ids])[1:]
        return ",".join([decimal[i] for i in ids]), len(ids), text

    ids, texts, held = [], [], 0

    def flush() -> pa.RecordBatch:
        n, ids_sha, text_sha = [], [], []
        for words in encoder.encode(texts, join):
            n.append(sum(w[1] for w in words))
            ids_sha.append(hashlib.sha256(",".join([w[0] for w in words]).encode()).hexdigest())
            text = "".join([w[2] for w in words])
            text = text[1:] if vocab.prefix and text.startswith(" ") else text
            text_sha.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    for i, text in text_rows(batches, "id", "text"):
        ids.append(i)
        texts.append(text or "")
        held += len(texts[-1])
        if held > 1_000_000:
            yield flush()
            ids, texts, held = [], [], 0
    if ids:
        yield flush()


def round_trip(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_tokens, ids_sha256, decoded_sha256)``, one row for each
    row: digests of a text's ids and of the text they decode to. A null text
    is empty and has no ids."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    kind = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return src.mapInArrow(partial(_digest_task, model=model), kind).withColumnRenamed("id", id_col)


def _ids_task(batches: Iterator[pa.RecordBatch], model: bytes, text_at: int) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(Vocabulary(model))
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = [t or "" for t in part.column(text_at).to_pylist()]
            flat = [np.concatenate([np.zeros(0, np.int32), *w]) for w in encoder.encode(texts, lambda ids: np.array(ids, np.int32))]
            ends = np.cumsum([0] + [len(f) for f in flat], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat).astype(np.int32)))
            yield pa.record_batch([*part.columns, ids], [*part.schema.names, "ids"])


def encode(docs: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of ``text_col``, without begin or end ids; of a
    null text an empty list. Other columns pass through whatever their names."""
    small_batches(docs.sparkSession)
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    schema = T.StructType([*plain.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    out = plain.mapInArrow(partial(_ids_task, model=model, text_at=names.index(text_col)), schema)
    return out.toDF(*names, ids_col)


def decode(encoded: DataFrame, model: bytes, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text that ids decode to; null ids give null."""

    @F.pandas_udf("string")
    def texts(ids):
        vocab = Vocabulary(model)
        return ids.map(lambda x: None if x is None else decode_ids(vocab, [int(i) for i in x]))

    return encoded.withColumn(text_col, texts(F.col(ids_col)))
