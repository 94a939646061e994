"""WARC archives: writing segmented, chunked records and reassembling them.

``write_archives`` writes one record per page. Of pages with equal payloads of at
least ``min_revisit`` bytes, the one with the largest id is a response and the
others are revisits that refer to it. A block above ``SEGMENT_BYTES`` is cut into
a first record and continuations. ``read_archives`` groups continuations by
origin id, orders them by segment number, verifies the total length and decodes
the chunked transfer framing.

Defined cases: null html is an empty payload; a null url is an empty target; null
ids stay null and never refer to each other's records; rows with the same id and
payload are all responses; an empty table gives an empty archive. A record whose
segments are missing or whose lengths disagree has ``valid`` false and null payload
columns. Only the three named columns are read, so extra columns do not clash.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import key_bitmap, marked, stored

SEGMENT_BYTES = 16 << 10       # longest block of one record
CHUNK_BYTES = 4 << 10          # longest HTTP chunk
RECORDS_PER_FILE = 2048        # with SEGMENT_BYTES this bounds a file to about 32 MB unpacked
END = b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for i in range(0, len(payload), size):
        part = payload[i:i + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        part = body[line + 2:line + 2 + size]
        if len(part) < size or body[line + 2 + size:line + 4 + size] != b"\r\n":
            raise ValueError("chunk is cut short")
        parts.append(part)
        at = line + 4 + size


def _head(fields: list[tuple[str, object]], length: int) -> bytes:
    lines = [f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", length)] if v is not None]
    return ("WARC/1.1\r\n" + "".join(lines) + "\r\n").encode()


def _records(row: dict) -> list[bytes]:
    url = (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    own = f"<urn:uuid:{row['uid']}>"
    page = row["page_id"]
    common = [("WARC-Date", DATE), ("WARC-Target-URI", url), ("X-Page-ID", page)]
    digest = ("WARC-Payload-Digest", f"sha1:{row['digest']}")
    if row["refers_to"] is not None:
        return [_head([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, digest,
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       ("X-Refers-To-Page", row["refers_to"]),
                       ("Content-Type", "application/http;msgtype=response")], len(HTTP)) + HTTP]
    block = HTTP + chunked(row["payload"])
    pieces = [block[i:i + SEGMENT_BYTES] for i in range(0, len(block), SEGMENT_BYTES)]
    one = len(pieces) == 1
    out = [_head([("WARC-Type", "response"), ("WARC-Record-ID", own), *common, digest,
                  ("WARC-Segment-Number", None if one else 1),
                  ("Content-Type", "application/http;msgtype=response")], len(pieces[0])) + pieces[0]]
    for k, piece in enumerate(pieces[1:], 2):
        out.append(_head([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{row['uid']}:{k}>"),
                          *common, ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", k),
                          ("WARC-Segment-Total-Length", len(block) if k == len(pieces) else None)],
                         len(piece)) + piece)
    return out


def _write(batches):
    for batch in batches:
        out = [r for row in batch.to_pylist() for r in _records(row)]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def plan_records(pages: DataFrame, min_revisit: int) -> DataFrame:
    """page_id, url, payload, digest, refers_to.

    Only keys are shuffled to find equal payloads. Pages whose digest is in no group
    (told by a bitmap of fixed size) go on without a shuffle of their payload."""
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = (pages.select("page_id", "url", payload.alias("payload"))
            .withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload")))
    groups = (rows.where((F.col("size") >= min_revisit) & F.col("page_id").isNotNull())
              .groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
              .where("n > 1").select("digest", "last"))
    groups = stored(groups, "warc-groups")
    bitmap = key_bitmap(F.col("digest"), groups)
    own = F.col("page_id") == F.col("last")
    twins = (marked(rows, F.col("digest"), bitmap, "left_semi").join(groups, "digest", "left")
             .withColumn("refers_to", F.when(~own, F.col("last"))))
    single = marked(rows, F.col("digest"), bitmap, "left_anti").withColumn("refers_to", F.lit(None).cast("long"))
    names = ["page_id", "url", "payload", "digest", "refers_to"]
    return twins.select(*names).unionByName(single.select(*names))


def write_archives(pages: DataFrame, path: str, min_revisit: int = 1000) -> None:
    """Gzipped WARC files below ``path``; a record's end mark is the line separator."""
    rows = plan_records(pages, min_revisit).withColumn("uid", F.expr("uuid()"))
    (rows.mapInArrow(_write, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", END.decode()).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse_records(data: bytes):
    """(header fields, block) of every record of one unpacked archive."""
    at = 0
    while at < len(data):
        end = data.index(END, at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        head = dict(x.split(": ", 1) for x in lines[1:])
        start = end + len(END)
        stop = start + int(head["Content-Length"])
        if data[stop:stop + len(END)] != END:
            raise ValueError("a record does not end where its length says")
        yield head, data[start:stop]
        at = stop + len(END)


RECORD = pa.schema([("key", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("page_id", pa.int64()),
                    ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                    ("digest", pa.string()), ("block", pa.binary())])
RECORD_DDL = ("key string, segment int, total long, page_id long, url string, record_type string, refers_to long,"
              " digest string, block binary")


def _number(x):
    return None if x is None else int(x)


def _parse(segmented: bool):
    def parse(batches):
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for head, block in parse_records(gzip.decompress(data.as_py())):
                    if ("WARC-Segment-Number" in head) is not segmented:
                        continue
                    rows.append((head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"]),
                                 _number(head.get("WARC-Segment-Number")),
                                 _number(head.get("WARC-Segment-Total-Length")),
                                 _number(head.get("X-Page-ID")), head.get("WARC-Target-URI"), head["WARC-Type"],
                                 _number(head.get("X-Refers-To-Page")),
                                 head.get("WARC-Payload-Digest", "").removeprefix("sha1:"), block))
                yield pa.RecordBatch.from_pylist([dict(zip(RECORD.names, r, strict=True)) for r in rows], RECORD)
    return parse


def _decode(batches):
    """Payload, its size and digest from the ordered segments of each record."""
    schema = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("header_digest", pa.string()),
                        ("payload", pa.binary()), ("valid", pa.bool_())])
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            parts = row.pop("parts")
            block = b"".join(p["block"] for p in parts)
            numbers = [p["segment"] for p in parts]
            valid = numbers in ([None], list(range(1, len(parts) + 1)))
            if numbers != [None]:
                valid = valid and len(parts) > 1 and parts[-1]["total"] == len(block)
            payload = None
            if valid and row["record_type"] == "response":
                try:
                    payload = unchunked(block[block.index(END) + len(END):])
                    valid = hashlib.sha1(payload).hexdigest() == row["header_digest"]
                except ValueError:
                    valid = False
            out.append(row | {"payload": payload if valid else None, "valid": valid})
        yield pa.RecordBatch.from_pylist(out, schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """key, page_id, url, record_type, refers_to, header_digest, payload (of responses), valid.

    Whole records are decoded where they are read; only the segments of cut
    records are shuffled, by their origin id."""
    files = spark.read.format("binaryFile").load(path).select("content")
    part = F.struct("segment", "total", "block")
    names = ["page_id", "url", "record_type", "refers_to", F.col("digest").alias("header_digest")]
    whole = files.mapInArrow(_parse(False), RECORD_DDL).select("key", F.array(part).alias("parts"), *names)
    # a cut record: its first segment (which has the greatest type and digest) and its continuations
    cut = (files.mapInArrow(_parse(True), RECORD_DDL).groupBy("key").agg(
        F.sort_array(F.collect_list(part)).alias("parts"), F.first("page_id").alias("page_id"),
        F.first("url").alias("url"), F.max("record_type").alias("record_type"),
        F.max("refers_to").alias("refers_to"), F.max("digest").alias("header_digest")))
    return whole.unionByName(cut).mapInArrow(
        _decode, "key string, page_id long, url string, record_type string, refers_to long,"
                 " header_digest string, payload binary, valid boolean")


def archive_digests(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, valid per record:
    a revisit takes size and digest from the response that it refers to."""
    read = stored(read_archives(spark, path).select(
        "page_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "header_digest", "valid"), "warc-read")
    same = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "valid"]
    responses = read.where("record_type = 'response'").select(*same)
    found = (responses.where("page_id is not null and valid").groupBy(F.col("page_id").alias("refers_to"))
             .agg(F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest")))
    revisits = read.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(
        found, "refers_to", "left")
    revisits = revisits.withColumn("valid", F.col("valid") & F.col("payload_digest").eqNullSafe(F.col("header_digest")))
    return responses.unionByName(revisits.select(*same))


def round_trip(pages: DataFrame, min_revisit: int = 1000) -> DataFrame:
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, min_revisit)
    return archive_digests(pages.sparkSession, path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
     m AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to, true AS valid
FROM p LEFT JOIN m USING (payload_digest)
"""
