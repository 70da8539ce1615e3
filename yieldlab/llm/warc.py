"""WARC archives: writing, and reading back with segment reassembly.

``write_archive`` makes one WARC 1.1 file of each partition: HTTP responses in
chunked transfer framing, revisits of equal payloads, and payloads above
``segment_chars`` in segments (a first record and ``continuation`` records
that name its identifier). ``read_archive`` takes the files apart by their
content lengths, groups continuation records by the identifier of their
origin, orders them by segment number, verifies numbers and total length,
decodes the chunked framing and verifies the payload's digest.

Archives are written and read by Spark's own sources, so any store will do;
a file is read by one task, so the writer keeps files to ``file_rows`` rows.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, small_batches, text_rows

LEAST_REVISIT = 1000  # bytes of a payload that may be revisited
SEGMENT_CHARS, CHUNK_CHARS, FILE_ROWS = 16_384, 4096, 2000
DATE = "2024-01-01T00:00:00Z"
VERSION = b"WARC/1.1"


# ---- writing ------------------------------------------------------------------


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """``(page_id, url, html, digest, record_type, refers_to)``: of equal
    payloads of at least ``least`` bytes the one with the largest id is the
    response, the others revisit it. Null payloads are empty."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    large = F.octet_length("html") >= least
    last = src.filter(large).groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = src.join(last, "digest", "left").withColumn("last", F.when(large, F.col("last")))
    revisit = F.col("last").isNotNull() & (F.col("page_id") < F.col("last"))
    return joined.select("page_id", "url", "html", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("last")).alias("refers_to"))


def record_id(page_id: int | None, serial: str = "") -> str:
    """A page's name, and behind # what tells its records apart."""
    return f"<urn:page:{'' if page_id is None else page_id}{'#' * bool(serial)}{serial}>"


def _record(kind: str, fields: list[tuple[str, str]], block: str) -> str:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), ("WARC-Date", DATE), *fields, ("Content-Length", str(len(block.encode("utf-8"))))])
    return f"WARC/1.1\r\n{head}\r\n{block}\r\n"  # the writer's line separator is the last of the two line ends


def chunked(payload: str, size: int) -> str:
    """A payload in chunked transfer framing, cut between characters."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return "".join(f"{len(p.encode('utf-8')):x}\r\n{p}\r\n" for p in parts) + "0\r\n\r\n"


def page_records(page_id: int | None, url: str | None, html: str, digest: str, kind: str, refers_to: int | None, segment_chars: int, chunk_chars: int, serial: str = "0") -> list[str]:
    """The records of one page; ``serial`` is new for each page of an archive."""
    own_id = record_id(page_id, serial)
    fields = [("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")), ("WARC-Payload-Digest", f"sha1:{digest}")]
    mime = ("Content-Type", "application/http;msgtype=response")
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if kind == "revisit":
        own = [("WARC-Record-ID", own_id), *fields, ("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), mime]
        return [_record("revisit", own, head)]
    block = head + chunked(html, chunk_chars)
    parts = [block[i : i + segment_chars] for i in range(0, len(block), segment_chars)]
    if len(parts) == 1:
        return [_record("response", [("WARC-Record-ID", own_id), *fields, mime], block)]
    out = [_record("response", [("WARC-Record-ID", own_id), *fields, ("WARC-Segment-Number", "1"), mime], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        own = [("WARC-Record-ID", record_id(page_id, f"{serial}/{n}")), fields[0], ("WARC-Segment-Origin-ID", own_id), ("WARC-Segment-Number", str(n))]
        if n == len(parts):
            own.append(("WARC-Segment-Total-Length", str(len(block.encode("utf-8")))))
        out.append(_record("continuation", own, part))
    return out


def _write_task(batches: Iterator[pa.RecordBatch], segment_chars: int, chunk_chars: int) -> Iterator[pa.RecordBatch]:
    out, size, part = [], 0, TaskContext.get().partitionId()
    for n, row in enumerate(text_rows(batches, "page_id", "url", "html", "digest", "record_type", "refers_to")):
        for record in page_records(*row, segment_chars, chunk_chars, f"{part}-{n}"):
            out.append(record)
            size += len(record)
        if size > 2_000_000:
            yield pa.record_batch([pa.array(out, pa.string())], ["value"])
            out, size = [], 0
    if out:
        yield pa.record_batch([pa.array(out, pa.string())], ["value"])


def write_archive(planned: DataFrame, path: str, segment_chars: int = SEGMENT_CHARS, chunk_chars: int = CHUNK_CHARS, file_rows: int = FILE_ROWS, compression: str = "gzip") -> None:
    """Write the records of ``plan_records`` as WARC files to the folder
    ``path`` (``compression``: "gzip" or "none"). A null url is empty."""
    small_batches(planned.sparkSession)
    records = planned.mapInArrow(partial(_write_task, segment_chars=segment_chars, chunk_chars=chunk_chars), "value string")
    records.write.mode("overwrite").option("lineSep", "\r\n").option("compression", compression).option("maxRecordsPerFile", file_rows).text(path)


# ---- reading ------------------------------------------------------------------


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of a file."""
    at, end = 0, len(data)
    while at < end:
        if data[at : at + 5] != b"WARC/":
            if not data[at:].strip(b"\r\n"):
                return
            raise ValueError(f"no record at byte {at}")
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(fields["content-length"])
        at = stop + 4 + size
        if at > end:
            raise ValueError("the file ends within a record")
        yield fields, data[stop + 4 : at]
        while data[at : at + 2] == b"\r\n":
            at += 2


def dechunk(block: bytes) -> bytes:
    """The payload of an HTTP message, out of its chunked framing if it's in one."""
    head, _, body = block.partition(b"\r\n\r\n")
    codings = [line.partition(b":")[2].strip().lower() for line in head.split(b"\r\n")[1:] if line.partition(b":")[0].strip().lower() == b"transfer-encoding"]
    if b"chunked" not in codings:
        return body
    out, at = [], 0
    while True:
        stop = body.index(b"\r\n", at)
        size = int(body[at:stop].partition(b";")[0], 16)
        if not size:
            return b"".join(out)
        at = stop + 2
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk doesn't end where its size says")
        out.append(body[at : at + size])
        at += size + 2


_FIELDS = ("warc-type", "warc-record-id", "warc-target-uri", "warc-payload-digest", "warc-refers-to", "warc-segment-origin-id", "warc-segment-number", "warc-segment-total-length")
_NAMES = ("type", "record_id", "uri", "digest", "refers_to", "origin", "segment", "total")


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (data,) in text_rows(batches, "content"):
        data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
        rows, size = [], 0
        for fields, block in parse(data):
            own = [fields.get(f) for f in _FIELDS]
            rows.append((*own[:6], *(int(v) if v else None for v in own[6:]), block))
            size += len(block)
            if size > 4_000_000:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.binary()]
    return pa.record_batch([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], [*_NAMES, "block"])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the archives in a folder, as they stand."""
    small_batches(spark)
    kind = "type string, record_id string, uri string, digest string, refers_to string, origin string, segment int, total long, block binary"
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read_task, kind)


@F.pandas_udf(T.BinaryType())
def _payload(blocks):
    return blocks.map(lambda b: None if b is None else dechunk(bytes(b)))


def reassemble(records: DataFrame) -> DataFrame:
    """``(type, record_id, uri, digest, refers_to, payload, whole)``: one row
    for each record that isn't a continuation.

    ``whole`` is false where segments are missing, come twice, or don't add
    up to the total length, or where the payload isn't what its digest says;
    the payload is then null. A revisit has no payload of its own (null) and
    is whole. Only segmented records are shuffled."""
    single = records.filter("segment is null").select("type", "record_id", "uri", "digest", "refers_to", "block", F.lit(True).alias("whole"))
    parts = records.filter("segment is not null").withColumn("of", F.coalesce("origin", "record_id"))
    first = F.col("segment") == 1

    def of_first(c: str):
        return F.max(F.when(first, F.col(c))).alias(c)

    group = parts.groupBy("of").agg(
        *[of_first(c) for c in ("type", "record_id", "uri", "digest", "refers_to")],
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
    )
    numbers = F.transform("parts", lambda p: p["segment"])
    whole = (numbers == F.sequence(F.lit(1), F.size("parts"))) & (F.col("total") == F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + F.octet_length(p["block"])))
    block = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["block"]))
    joined = group.filter("record_id is not null").withColumn("whole", F.coalesce(whole, F.lit(False)))
    joined = joined.select("type", "record_id", "uri", "digest", "refers_to", F.when(F.col("whole"), block).alias("block"), "whole")
    every = single.unionByName(joined)
    payload = _payload(F.when((F.col("type") != "revisit") & F.col("whole"), F.col("block")))
    out = every.select("type", "record_id", "uri", "digest", "refers_to", payload.alias("payload"), "whole")
    right = F.col("payload").isNull() | F.col("digest").isNull() | (F.concat(F.lit("sha1:"), F.sha1("payload")) == F.col("digest"))
    return out.select("type", "record_id", "uri", "digest", "refers_to", F.when(right, F.col("payload")).alias("payload"), (F.col("whole") & right).alias("whole"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The reassembled records of the archives in a folder."""
    return reassemble(read_records(spark, path))


def page_report(archived: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of
    an archive that ``write_archive`` made: a revisit has the payload of the
    response that it refers to. A row for each page written, whether ids are
    null or repeated."""

    def page(c: str):
        return F.regexp_extract(c, "^<urn:page:(-?[0-9]+)[#>]", 1)

    rows = archived.filter("whole").select(
        F.expr("nullif(regexp_extract(record_id, '^<urn:page:(-?[0-9]+)[#>]', 1), '')").cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("own"), F.regexp_extract("digest", "^sha1:(.*)$", 1).alias("payload_digest"),
        F.col("type").alias("record_type"), F.when(F.col("type") == "revisit", page("refers_to").cast("long")).alias("refers_to"),
    )
    rows = materialize(rows, "pages")  # without payloads; the archive is taken apart once
    of = ["refers_to", "payload_digest"]
    theirs = rows.filter("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("own").alias("theirs"))
    wanted = theirs.join(rows.filter("record_type = 'revisit'").select(*of).distinct(), of).groupBy(*of).agg(F.max("theirs").alias("theirs"))
    out = rows.join(wanted, of, "left")
    return out.select("page_id", F.coalesce("own", "theirs").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
