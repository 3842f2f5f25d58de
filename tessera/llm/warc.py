"""WARC archives with segmented records, written and read back.

Method: a page becomes a response record whose block is an HTTP message in
chunked framing, or, if another page has its payload, a revisit record.  Blocks
above ``SEGMENT_BYTES`` are cut in segments: the first is the response record
(segment number 1), the rest are continuation records that name it.  The
archives are gzip files of at most ``FILE_RECORDS`` records in the shared
folder.  Reading parses each file by its record lengths; segments are grouped
by origin identifier, ordered by number, checked against the total length and
joined, and the chunked framing is decoded.  Only segmented records are
shuffled; a group is one record's block.

Defined cases: a null html is an empty payload; a null page_id has a record of
its own, which is a response if only such pages have its payload, else it
revisits the smallest page_id; rows that repeat the smallest page_id are all
responses; a null url is left out of the record; control and non-ASCII
characters of a url are percent-encoded in the header; an empty table writes
no record.  A missing segment, a wrong length or digest ends the job.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import REGISTRY, _shuffles_removed, slices, table
from tessera.session import scratch_path

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
FILE_RECORDS = 2048
END = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a body in chunked framing (extensions and trailers are skipped)."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("broken chunk framing")
        out.append(body[at:at + size])
        at += size + 2


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the two line ends that close it."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def page_records(page_id, url, payload: bytes, least, number: int, segment: int = SEGMENT_BYTES, date: str = "1970-01-01T00:00:00Z"):
    """The records of one page; ``least`` is the page whose response holds the payload."""
    urn = f"<urn:record:{number}>"
    head = [("WARC-Record-ID", urn), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    head.append(("WARC-Payload-Digest", "sha1:" + payload_digest(payload)))
    if page_id != least:
        yield record([("WARC-Type", "revisit"), *head, ("WARC-Refers-To-Page", str(least)),
                      ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                      ("Content-Type", "application/http; msgtype=response")], b"HTTP/1.1 200 OK\r\n\r\n")
        return
    block = HTTP + chunked(payload)
    head = [("WARC-Type", "response"), *head, ("Content-Type", "application/http; msgtype=response")]
    if len(block) <= segment:
        yield record(head, block)
        return
    yield record([*head, ("WARC-Segment-Number", "1")], block[:segment])
    total = -(-len(block) // segment)
    for k in range(2, total + 1):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:record:{number}:{k}>"), ("WARC-Date", date),
                ("WARC-Segment-Origin-ID", urn), ("WARC-Segment-Number", str(k))]
        if k == total:
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        yield record(more, block[(k - 1) * segment:k * segment])


def parse(content: bytes):
    """(headers, block) of each record of an archive file."""
    at = 0
    while at < len(content):
        end = content.index(END, at)
        first, *lines = content[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("no record where one should begin")
        headers = dict(x.split(": ", 1) for x in lines)
        start = end + len(END)
        size = int(headers["Content-Length"])
        if content[start + size:start + size + len(END)] != END:
            raise ValueError("a record does not end where its length says")
        yield headers, content[start:start + size]
        at = start + size + len(END)


def _write(segment: int):
    def run(batches):
        for batch in slices(batches, "html", 1 << 20):
            out = []
            for page_id, url, html, least, number in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "least", "number"))):
                out += page_records(page_id, url, (html or "").encode(), least, number, segment)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
    return run


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT_BYTES, file_records: int = FILE_RECORDS) -> None:
    """Write ``pages`` (page_id, url, html) as gzip archives under ``path``."""
    rows = pages.select("page_id", "url", "html", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"))
    least = rows.groupBy("digest").agg(F.min("page_id").alias("least"))
    numbered = rows.join(least.hint("shuffle_hash"), "digest").withColumn("number", F.monotonically_increasing_id())
    records = numbered.select("page_id", "url", "html", "least", "number").mapInArrow(_write(segment), "record binary")
    with _shuffles_removed(pages.sparkSession):
        (records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END.decode())
         .option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path))


RECORD_DDL = ("type string, page_id long, origin string, number int, total long, digest string, refers_to long, "
              "block binary, payload_bytes long")
RECORD = pa.schema([("type", pa.string()), ("page_id", pa.int64()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()),
                    ("digest", pa.string()), ("refers_to", pa.int64()), ("block", pa.binary()), ("payload_bytes", pa.int64())])


def _payload(block: bytes, digest: str) -> bytes:
    head, body = block.split(END, 1)
    payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    if payload_digest(payload) != digest:
        raise ValueError(f"payload does not have the digest {digest}")
    return payload


def _read(batches):
    number = lambda v: None if v is None else int(v)
    for batch in batches:
        for content in batch.column("content"):
            out = []
            for h, block in parse(gzip.decompress(content.as_py())):
                digest = h.get("WARC-Payload-Digest", "sha1:")[5:]
                segment, size = number(h.get("WARC-Segment-Number")), None
                if h["WARC-Type"] == "response" and segment is None:
                    size, block = len(_payload(block, digest)), None
                elif h["WARC-Type"] == "revisit":
                    block = None
                out.append((h["WARC-Type"], number(h.get("X-Page-ID")), h.get("WARC-Segment-Origin-ID", h["WARC-Record-ID"]), segment,
                            number(h.get("WARC-Segment-Total-Length")), digest, number(h.get("WARC-Refers-To-Page")), block, size))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), RECORD)], schema=RECORD)


def _reassemble(batches):
    for batch in batches:
        out = {"page_id": [], "digest": [], "payload_bytes": []}
        for row in batch.to_pylist():
            parts = sorted(row["parts"], key=lambda p: p["number"])
            if [p["number"] for p in parts] != list(range(1, len(parts) + 1)):
                raise ValueError(f"segments missing of {row['origin']}")
            block = b"".join(p["block"] for p in parts)
            if len(block) != parts[-1]["total"]:
                raise ValueError(f"{row['origin']} has {len(block)} bytes of {parts[-1]['total']}")
            first = parts[0]
            out["page_id"].append(first["page_id"])
            out["digest"].append(first["digest"])
            out["payload_bytes"].append(len(_payload(block, first["digest"])))
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("page_id", pa.int64()), ("digest", pa.string()), ("payload_bytes", pa.int64())]))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all pages in archives."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    records = files.mapInArrow(_read, RECORD_DDL)
    whole = records.where("payload_bytes IS NOT NULL").select("page_id", "digest", "payload_bytes")
    segments = records.where("number IS NOT NULL")
    joined = (segments.groupBy("origin").agg(F.collect_list(F.struct("number", "total", "page_id", "digest", "block")).alias("parts"))
              .mapInArrow(_reassemble, "page_id long, digest string, payload_bytes long"))
    responses = whole.unionByName(joined)
    sizes = responses.groupBy("digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = records.where("type = 'revisit'").select("page_id", "digest", "refers_to").join(sizes, "digest", "left")
    return responses.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"),
                            F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to"))


OP3_SQL = r"""
WITH RECURSIVE p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT d, min(page_id) AS least FROM p GROUP BY d),
bits AS (SELECT DISTINCT d, array_to_string(list_transform(range(1, 41), lambda i: right('000' || bin(('0x' || d[i])::INT), 4)), '') AS b FROM p),
text32 AS (SELECT d, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + list_sum(list_transform(range(1, 6), lambda j: substr(b, 5 * i + j, 1)::INT * (1 << (5 - j))))::INT, 1)), '') AS s FROM bits)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, s AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM least THEN NULL ELSE least END AS refers_to
FROM p JOIN m USING (d) JOIN text32 USING (d)
"""


@REGISTRY("op3_warc_segments", OP3_SQL)
def op3(spark, sf_dir):
    """Archives of `pages`, written to the shared folder and read back."""
    path = scratch_path(spark, "op3-warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return read_archives(spark, path)
