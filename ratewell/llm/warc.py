"""WARC archives with a Zstandard dictionary: writer and reader.

Pages are dealt into archives of a bounded size. A task builds a dictionary from the records of its archive, puts it into
a leading skippable frame, and compresses every record as a frame of its own, so that a reader can start at any record.
Archives are rows (name, content) of a Parquet table: Spark commits whole tasks, so a lost executor leaves no half-written
archive, and any of them can be copied out as a .warc.zst file.

Of records with equal payloads the one with the largest page_id is the response and the others revisit it, if the payload
has at least `least` bytes. Null html: an empty payload. Null url: a record without a target. A null page_id never becomes
the page that others refer to; it revisits a page with an id, and without one it is a response. Rows that share the largest
id and the payload are all responses. A payload larger than an archive makes an archive of its own. Control characters in
urls are percent-encoded in the header. No pages: no archives. Only page_id, url and html are read, so other columns can have
any name."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES, LEVEL = 8 << 20, 48 << 10, 3 << 20, 3
# Fixed values of the format: the magic number of the skippable frame that holds the dictionary, and a fixed record date.
DICTIONARY_FRAME, DATE = 0x184D2A5D, "2026-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)))
    if page_id is not None:
        head.append(("WARC-Page-ID", str(page_id)))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Payload-Length", str(len(payload)))]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if refers_to is None:
        body += payload
    else:
        head += [("WARC-Refers-To-Page-ID", str(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(body)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "replace") + b"\r\n" + body + b"\r\n\r\n"


def dictionary_of(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the first SAMPLE_BYTES of records spread over the archive; raw content where there is too little to train on."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    sample = [r[:128 << 10] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=512, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(r[:2048] for r in sample)[:DICTIONARY_BYTES].ljust(8, b" "), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive_of(records: list[bytes]) -> bytes:
    known = dictionary_of(records)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
    raw = known.as_bytes()
    return b"".join([struct.pack("<II", DICTIONARY_FRAME, len(raw)), raw, *map(packer.compress, records)])


def records_of(archive: bytes) -> Iterator[bytes]:
    """The records of one archive, read frame by frame."""
    magic, size = struct.unpack_from("<II", archive)
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive has no leading dictionary frame")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(archive[8:8 + size]))
    rest = archive[8 + size:]
    while rest:
        frame = reader.decompressobj()
        made = frame.decompress(rest)
        if not frame.eof:
            raise ValueError("the archive ends inside a frame")
        yield made
        rest = frame.unused_data


def parsed(one: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = one.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[:int(fields["Content-Length"])]


def with_targets(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to (null: the record is a response)."""
    rows = pages.select("page_id", "url", F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8").alias("payload")).withColumn("key", F.unhex(F.sha1("payload")))
    firsts = rows.where(F.length("payload") >= least).groupBy("key").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("key", "first")
    known = rows.join(firsts, "key", "left")
    return known.select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes the archives; the table (name, n_records, content)."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def closed() -> pd.DataFrame:
            made = archive_of(held)
            return pd.DataFrame({"name": [hashlib.sha1(made).hexdigest() + ".warc.zst"], "n_records": [len(held)], "content": [made]})

        for b in batches:
            for page, url, payload, target in zip(b.page_id.astype(object), b.url, b.payload, b.refers_to.astype(object)):
                whole = lambda v: None if pd.isna(v) else int(v)
                one = record(whole(page), None if pd.isna(url) else url, bytes(payload), payload_digest(payload), whole(target))
                if held and size + len(one) > ARCHIVE_BYTES:
                    yield closed()
                    held.clear()
                    size = 0
                held.append(one)
                size += len(one)
        if held:
            yield closed()

    # Ids over 2^53 must not pass through floating point: nullable ids travel as text.
    rows = with_targets(pages, least).withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return stored(rows.mapInPandas(pack, "name string, n_records long, content binary"), "warc")


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b.content:
                rows: list[tuple] = []
                for one in records_of(bytes(content)):
                    fields, body = parsed(one)
                    digest, payload = fields["WARC-Payload-Digest"].removeprefix("sha1:"), None
                    if fields["WARC-Type"] == "response":
                        payload = body.partition(b"\r\n\r\n")[2]
                        if payload_digest(payload) != digest or len(payload) != int(fields["WARC-Payload-Length"]):
                            raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
                    rows.append((fields.get("WARC-Page-ID"), fields.get("WARC-Target-URI"), int(fields["WARC-Payload-Length"]), digest, fields["WARC-Type"], fields.get("WARC-Refers-To-Page-ID"), payload))
                yield pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    kind = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"
    return archives.select("content").mapInPandas(read, kind).withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


ROUNDTRIP_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
k AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
f AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top, ('x' || h) AS x FROM k)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (list_sum(list_transform(range(0, 5), lambda j: CASE WHEN substr(unhex(h)::BIT::VARCHAR, i * 5 + j + 1, 1) = '1' THEN (16 >> j::INTEGER) ELSE 0 END)))::BIGINT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM top AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM f
"""
