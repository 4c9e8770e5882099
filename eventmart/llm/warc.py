"""WARC archives: records written in segments, read back and put together again.

Writing: one record per page. Equal payloads are stored once, as a response; the others refer to it. A block longer than
a segment goes on in continuation records. Files are gzip-compressed WARC 1.1, each bounded by a number of records.

Reading: records are parsed file by file, continuation records grouped by the identifier of their origin, ordered by
segment number, checked against the stated total length, and the chunked framing of the payload is taken off.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT_BYTES = 16 << 10  # of a block in one record
CHUNK_BYTES = 4 << 10  # of the chunked transfer framing
FILE_RECORDS = 512  # so a file holds at most SEGMENT_BYTES x FILE_RECORDS and the headers
MIN_SHARED = 1000  # payload bytes from which copies are stored as revisits

_END = "\r\n\r\n"
_RECORDS = "struct<record_id:string, kind:string, segment:int, origin_id:string, total:bigint, page_id:bigint, refers_to:bigint, digest:string, block:binary>"
_PAGES = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def _cuts(data: bytes, size: int) -> Iterator[bytes]:
    """Parts of about ``size`` bytes that end where a character ends, so that files stay valid UTF-8."""
    begin = 0
    while begin < len(data):
        end = begin + size
        while begin < end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        end = end if end > begin else begin + size
        yield data[begin:end]
        begin = end


def _chunked(payload: bytes) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in _cuts(payload, CHUNK_BYTES)) + b"0\r\n\r\n"


def _unchunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        parts.append(body[line + 2 : line + 2 + size])
        if len(parts[-1]) != size or body[line + 2 + size : line + 4 + size] != b"\r\n":
            raise ValueError("broken chunk")
        at = line + 4 + size


def _record(kind: str, record_id: str, block: bytes, **fields) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{record_id}>", "WARC-Date": "2026-01-01T00:00:00Z", **fields}
    lines = [f"{k.replace('_', '-')}: {v}" for k, v in head.items() if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode() + block


def records_of(page_id, url, payload: bytes, digest: str, refers_to, record_id: str) -> Iterator[bytes]:
    """The record of a page, and its continuation records."""
    fields = {
        "WARC_Target_URI": re.sub(r"[\x00-\x20\x7f]", "", url or "") or f"urn:page:{page_id}",
        "WARC_Page_ID": page_id, "WARC_Payload_Digest": f"sha1:{digest}",
    }
    if refers_to is not None:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Payload-Length: {len(payload)}\r\n\r\n".encode()
        yield _record("revisit", record_id, block, **fields, WARC_Refers_To_Page_ID=refers_to,
                      WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + _chunked(payload)
    first, *rest = _cuts(block, SEGMENT_BYTES)
    yield _record("response", record_id, first, **fields, WARC_Segment_Number=1 if rest else None)
    for k, part in enumerate(rest, 2):
        last = {"WARC_Segment_Total_Length": len(block)} if k == len(rest) + 1 else {}
        yield _record("continuation", hashlib.md5(f"{record_id}/{k}".encode()).hexdigest(), part,
                      WARC_Segment_Number=k, WARC_Segment_Origin_ID=f"<urn:uuid:{record_id}>", **last)


def write_archive(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (page_id, url, html) to WARC files below ``path``.

    Of equal payloads of at least MIN_SHARED bytes the one with the largest page_id is the response. A null html is an
    empty payload; rows that repeat the largest page_id are all responses; rows without page_id are written, and never
    referred to.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    shared = F.octet_length("payload") >= MIN_SHARED
    # one narrow row per digest: counted before the shuffle, so a payload of a third of all pages is no hot key
    holders = rows.where(shared).groupBy("digest").agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
    holders = holders.where("n > 1 and holder is not null").select("digest", "holder")
    placed = rows.join(holders, "digest", "left")
    refers = F.when(shared & (F.col("page_id").isNull() | (F.col("holder") != F.col("page_id"))), F.col("holder"))
    placed = placed.select("page_id", "url", "payload", "digest", refers.alias("refers_to"),
                           F.md5(F.concat_ws("/", "page_id", "digest", F.monotonically_increasing_id().cast("string"))).alias("record_id"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to", "record_id")]
            for row in zip(*columns):
                yield pa.RecordBatch.from_arrays([pa.array(list(records_of(*row)), pa.binary())], ["record"])

    records = placed.mapInArrow(_grouped(write), "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", _END).option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS
    ).text(path)


def _grouped(step):
    """Join small batches to larger ones, of about 4 MB."""

    def run(batches):
        held, size = [], 0
        for batch in step(batches):
            held.append(batch)
            size += batch.nbytes
            if size > 4 << 20:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return run


def parse_archive(data: bytes) -> Iterator[dict]:
    """Records of one WARC file, one after the other, by their stated lengths."""
    if data[:2] == b"\x1f\x8b":
        parts = []
        while data:  # one gzip member or many
            reader = zlib.decompressobj(31)
            parts.append(reader.decompress(data))
            data = reader.unused_data
        data = b"".join(parts)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        begin, length = end + 4, int(head["content-length"])
        block = data[begin : begin + length]
        if len(block) != length or data[begin + length : begin + length + 4] != b"\r\n\r\n":
            raise ValueError(f"broken record at byte {at}")
        at = begin + length + 4
        number = lambda key: int(head[key]) if head.get(key, "None") != "None" else None
        bare = lambda key: head[key].strip("<>").removeprefix("urn:uuid:") if key in head else None
        yield {
            "record_id": bare("warc-record-id"), "kind": head["warc-type"], "segment": number("warc-segment-number") or 1,
            "origin_id": bare("warc-segment-origin-id"), "total": number("warc-segment-total-length"),
            "page_id": number("warc-page-id"), "refers_to": number("warc-refers-to-page-id"),
            "digest": head.get("warc-payload-digest", "").removeprefix("sha1:"), "block": block,
        } | ({"origin_id": bare("warc-record-id")} if number("warc-segment-number") == 1 else {})


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record. Files are read whole by one task each: the writer bounds them."""
    kind = pa.schema([("record_id", pa.string()), ("kind", pa.string()), ("segment", pa.int32()), ("origin_id", pa.string()), ("total", pa.int64()),
                      ("page_id", pa.int64()), ("refers_to", pa.int64()), ("digest", pa.string()), ("block", pa.binary())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                held, size = [], 0
                for record in parse_archive(data.as_py()):
                    held.append(record)
                    size += len(record["block"])
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, kind)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, kind)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(path).select("content")
    return files.mapInArrow(parse, _RECORDS[len("struct<") : -1].replace(":", " "))


def payloads_of(records: DataFrame) -> DataFrame:
    """Pages from records: segments put together, lengths and digests verified, framing taken off.

    A group is one record's segments, so no larger than one page. A wrong total length, a missing segment, a broken
    chunk or another digest than the stated one raises.
    """
    common = ["kind", "page_id", "refers_to", "digest"]
    whole = records.where("origin_id is null").select(*common, F.lit(None).cast("bigint").alias("total"), F.array(F.struct("segment", "block")).alias("parts"))
    grouped = records.where("origin_id is not null").groupBy("origin_id").agg(
        F.max(F.when(F.col("kind") != "continuation", F.struct(*common))).alias("head"), F.max("total").alias("total"),
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
    )
    grouped = grouped.select("head.*", "total", "parts")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                block = b"".join(p["block"] for p in row["parts"])
                numbers = [p["segment"] for p in row["parts"]]
                if numbers != [*range(1, len(numbers) + 1)] or row["total"] not in (None, len(block)) or (len(numbers) > 1 and row["total"] is None):
                    raise ValueError(f"page {row['page_id']}: segments {numbers}, {len(block)} bytes of {row['total']}")
                head, _, body = block.partition(b"\r\n\r\n")
                if row["kind"] == "revisit":
                    size, payload, digest = int(re.search(rb"X-Payload-Length: (\d+)", head)[1]), None, row["digest"]
                else:
                    payload = _unchunked(body) if b"Transfer-Encoding: chunked" in head else body
                    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    if digest != row["digest"]:
                        raise ValueError(f"page {row['page_id']}: digest {digest}, stated {row['digest']}")
                out.append((row["page_id"], size, digest, row["kind"], row["refers_to"], payload))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types],
                                             ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    return whole.unionByName(grouped).mapInArrow(decode, _PAGES)


def broken_revisits(pages: DataFrame) -> DataFrame:
    """Digests that are referred to but that no response with this page_id bears; counted before they are joined."""
    asked = pages.where("record_type = 'revisit'").groupBy("refers_to", "payload_digest").agg(F.count("*").alias("n"))
    held = pages.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest")
    return asked.join(held, ["refers_to", "payload_digest"], "left_anti")
