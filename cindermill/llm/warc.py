"""WARC archives with segmented records.

Writing: each page becomes an HTTP response in chunked transfer framing. Blocks longer than a segment
are split into a first record and continuation records, which carry the origin's identifier and
their segment number, the last one also the total length. A page whose payload equals that of a page
with a smaller id is a revisit of the one with the smallest. Files are gzip-compressed.

Reading: files are read as lines and parsed as streams, so no file is ever held whole; complete records are decoded where they are, segments are
grouped by origin identifier, ordered by segment number and joined after their numbers and total
length are verified, then the chunked framing is decoded. A revisit is verified against the payload of the response that it names.

Defined cases: null html is an empty payload; repeated rows with the smallest page_id are each a
response and come back as often as they went in; a null page_id comes after every other. Records are
named by page_id and payload digest, so rows with one id, or none, and different html stay apart. A damaged or incomplete record, and a revisit whose response is
missing, come back with verified = false and null measures.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import materialise, scratch

DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def payload_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(data: bytes, size: int = 4096) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(data[a:a + size]), data[a:a + size]) for a in range(0, len(data), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = framed.index(b"\r\n", at)
        size = int(framed[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(framed[line + 2:line + 2 + size])
        if len(out[-1]) != size or framed[line + 2 + size:line + 4 + size] != b"\r\n":
            raise ValueError("a chunk ends early")
        at = line + 4 + size


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def page_records(page_id: int | None, url: str | None, payload: bytes, first_id: int | None, segment: int) -> Iterator[bytes]:
    """The records of one page; first_id is the page that has this payload first."""
    digest = payload_digest(payload)
    name = lambda key, *more: f"<urn:page:{':'.join(['' if key is None else str(key), digest, *more])}>"
    origin = name(page_id)
    common = [("WARC-Date", DATE), ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%~")), ("Page-Id", page_id), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Payload-Bytes", len(payload)), ("Content-Type", "application/http;msgtype=response")]
    if page_id != first_id:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", origin), ("WARC-Refers-To", name(first_id)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), *common], HTTP)
        return
    block = HTTP + chunked(payload)
    parts = [block[a:a + segment] for a in range(0, len(block), segment)]
    split = len(parts) > 1
    yield _record([("WARC-Type", "response"), ("WARC-Record-ID", origin), ("WARC-Segment-Number", 1 if split else None), *common], parts[0])
    for number, part in enumerate(parts[1:], start=2):
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", name(page_id, str(number))), ("WARC-Segment-Origin-ID", origin), ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", len(block) if number == len(parts) else None), ("WARC-Date", DATE), ("WARC-Target-URI", common[1][1])], part)


class Lines:
    """A stream over the lines of files, which come without their line ends."""

    def __init__(self, lines: Iterator[bytes]):
        self.lines, self.rest = lines, b""

    def readline(self) -> bytes:
        if self.rest:
            line, end, self.rest = self.rest.partition(b"\n")
            return line + end
        line = next(self.lines, None)
        return b"" if line is None else line + b"\n"

    def read(self, size: int) -> bytes:
        parts, held = [self.rest], len(self.rest)
        while held < size and (line := next(self.lines, None)) is not None:
            parts += (line, b"\n")
            held += len(line) + 1
        data = b"".join(parts)
        self.rest = data[size:]
        return data[:size]


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not at the start of a record")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.read(int(fields["content-length"]))


def write_archive(pages: DataFrame, path: str, segment: int = 16_384, pages_per_file: int = 20_000) -> None:
    """Write pages (page_id, url, html) as gzip-compressed WARC files below path."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("sha", F.sha1("payload"))
    # one row for each payload that occurs again; written first, so that its size is known when the join is planned
    again = materialise(rows.groupBy("sha").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("sha", "first_id", F.lit(True).alias("again")))
    first = F.when(F.col("again"), F.col("first_id")).otherwise(F.col("page_id"))
    known = rows.join(again, "sha", "left").select("page_id", "url", "payload", first.alias("first_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                rows = batch.slice(at, 256).to_pylist()
                # the writer ends each row with the last byte of the two line ends
                out = [b"".join(page_records(r["page_id"], r["url"], r["payload"], r["first_id"], segment))[:-1] for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    known.mapInArrow(run, "record binary").select(F.col("record").cast("string")).write.option("compression", "gzip").option("lineSep", "\n").option("maxRecordsPerFile", pages_per_file).text(path)


_COLUMNS = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("record", pa.string()), ("refers", pa.string()), ("claimed", pa.string()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary())])
RECORDS = "page_id long, record_type string, record string, refers string, claimed string, n_bytes long, payload_bytes long, payload_digest string, origin string, segment int, total long, block binary"


def _measured(block: bytes) -> tuple[int | None, str | None]:
    try:
        payload = http_payload(block)
    except ValueError:
        return None, None
    return len(payload), payload_digest(payload)


def _describe(fields: dict[str, str], block: bytes) -> dict:
    number = lambda name: int(fields[name]) if fields.get(name) else None
    row = {"page_id": number("page-id"), "record_type": fields["warc-type"], "record": fields["warc-record-id"], "refers": fields.get("warc-refers-to"), "claimed": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, "n_bytes": number("payload-bytes"), "segment": number("warc-segment-number"), "total": number("warc-segment-total-length")}
    if row["segment"]:
        return row | {"origin": fields.get("warc-segment-origin-id", fields["warc-record-id"]), "block": block}
    if row["record_type"] == "revisit":
        return row
    return row | dict(zip(("payload_bytes", "payload_digest"), _measured(block)))


def read_records(spark, path: str, held_bytes: int = 8 << 20) -> DataFrame:
    """Every record of the archives below path; complete ones measured, segments with their blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for fields, block in parse(Lines(line for batch in batches for line in batch.column(0).to_pylist())):
            rows.append(_describe(fields, block))
            held += 500 + len(rows[-1].get("block", b""))
            if held >= held_bytes:
                yield pa.RecordBatch.from_pylist(rows, schema=_COLUMNS)
                rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=_COLUMNS)

    # whole records are in one file, and files of one task follow each other
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").text(path)
    return lines.select(F.col("value").cast("binary")).mapInArrow(run, RECORDS)


def read_archive(spark, path: str) -> DataFrame:
    """One row per page of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to, verified."""
    records = materialise(read_records(spark, path))
    measures = ["page_id", "payload_bytes", "payload_digest", "record_type", "record", "claimed", "n_bytes"]
    whole = records.where("segment IS NULL AND record_type <> 'revisit'").select(*measures)
    segments = records.where("segment IS NOT NULL").groupBy("origin", "segment").agg(F.first("block").alias("block"), F.max("total").alias("total"), F.count("*").alias("times"), *(F.max(c).alias(c) for c in ("page_id", "claimed", "n_bytes")))
    joined = segments.groupBy("origin").agg(F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"), F.max("times").alias("times"), *(F.max(c).alias(c) for c in ("page_id", "claimed", "n_bytes")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                block = b"".join(p["block"] for p in row["parts"])
                whole = [p["segment"] for p in row["parts"]] == list(range(1, len(row["parts"]) + 1)) and len(block) == row["total"]
                size, digest = _measured(block) if whole else (None, None)
                out = {"page_id": row["page_id"], "payload_bytes": size, "payload_digest": digest, "record_type": "response", "record": row["origin"], "claimed": row["claimed"], "n_bytes": row["n_bytes"]}
                yield pa.RecordBatch.from_pylist([out] * row["times"], schema=pa.schema([_COLUMNS.field(c) for c in measures]))

    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, record string, claimed string, n_bytes long"
    responses = materialise(whole.unionByName(joined.mapInArrow(run, kinds)))
    revisits = records.where("record_type = 'revisit'").select("page_id", "record_type", "refers", "claimed", "n_bytes")
    # what the revisits name, one row for each response; written first, so that its size is known when the join is planned
    named = materialise(responses.join(revisits.select(F.col("refers").alias("record")).distinct(), "record", "left_semi").groupBy(F.col("record").alias("refers")).agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest")))
    rows = responses.withColumn("refers_to", F.lit(None).cast("long")).drop("record").unionByName(revisits.join(named, "refers", "left").drop("refers"))
    verified = F.coalesce((F.col("payload_digest") == F.col("claimed")) & (F.col("payload_bytes") == F.col("n_bytes")), F.lit(False))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", verified.alias("verified"))


def archive(pages: DataFrame, segment: int = 16_384) -> DataFrame:
    """Write pages to archives in the shared folder and read them back."""
    path = scratch(pages.sparkSession)
    write_archive(pages, path, segment)
    return read_archive(pages.sparkSession, path)
