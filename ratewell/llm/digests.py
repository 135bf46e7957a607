"""Document fingerprints: the quartile bucket digest, which stays alike when a part of a text changes.

The six byte triplets that begin at a byte and end at most four bytes on are hashed into 256 buckets. The counts'
quartiles turn each bucket into two bits: the quarter in which its count lies. A header holds a check byte, the logarithm
of the length and the quartiles' ratios. The difference of two digests adds the buckets' distances (three quarters apart
weigh 6) and the header's; likeness is 1 less difference / LIMIT, where LIMIT is what independent digests differ by on
average, and 0 beyond it.

The edit of a text takes its end from the next document. Documents are dealt into ranges of descending ids and sorted
there, texts once; a task walks its range and holds one document back. The last document of each range meets the first one
of the next range in a second, small step, and that of the last range the very first.

Null text: empty; texts of fewer than three bytes have empty buckets and differ by length and check byte. Texts are read
whole, 1 MB at a time. Repeated ids stand in the order of their texts' hashes, then texts, equal rows side by side; null ids
come last. A document without another is its own next one. No documents: no rows. Only doc_id and text are read, so other
columns can have any name."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

BUCKETS, CHUNK, LIMIT = 256, 1 << 20, 416
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
HEADER = 3
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_APART = np.array([0, 1, 2, 6], np.int64)
_QUARTERS = np.arange(256)[:, None] >> np.array([6, 4, 2, 0]) & 3
#: The distance of any two bytes, each the quarters of four buckets.
_DISTANCE = _APART[np.abs(_QUARTERS[:, None] - _QUARTERS[None])].sum(axis=2)


def bucket_counts(data: bytes) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    for lo in range(0, max(len(data) - 2, 0), CHUNK):
        b = np.frombuffer(data, np.uint8, min(CHUNK + 4, len(data) - lo), lo).astype(np.uint32)
        for j, (second, third) in enumerate(TRIPLETS):
            n = min(CHUNK, len(b) - third)
            if n > 0:
                x = b[:n] | b[second:second + n] << 8 | b[third:third + n] << 16
                counts += np.bincount((x ^ np.uint32(j << 24)) * np.uint32(2654435761) >> 24, minlength=BUCKETS)
    return counts


def fingerprint(text: str) -> str:
    data = text.encode()
    counts = bucket_counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    quarter = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = quarter.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    size = min(255, round(math.log1p(len(data)) / math.log(1.1)))
    ratios = int(15 * q1 / q3) << 4 | int(15 * q2 / q3) if q3 else 0
    return (bytes([zlib.crc32(data) & 255, size, ratios]) + body.astype(np.uint8).tobytes()).hex()


def difference(one: str, two: str) -> int:
    a, b = bytes.fromhex(one), bytes.fromhex(two)
    ratios = abs((a[2] >> 4) - (b[2] >> 4)) + abs((a[2] & 15) - (b[2] & 15))
    body = _DISTANCE[np.frombuffer(a, np.uint8, offset=HEADER), np.frombuffer(b, np.uint8, offset=HEADER)].sum()
    return int(body) + (a[0] != b[0]) + 2 * abs(a[1] - b[1]) + ratios


def likeness(one: str, two: str) -> float:
    return 1.0 if one == two else 1 - min(difference(one, two), LIMIT) / LIMIT


def edited(text: str, following: str) -> str:
    """The last third of the text gives way to as much of the beginning of the following one."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _judged(doc_id: int | None, text: str, own: str, following: str, theirs: str) -> tuple:
    new = edited(text, following)
    print_new = fingerprint(new)
    return (doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), own, print_new, likeness(own, print_new), likeness(own, theirs))


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The result of every document but the last of the range, which waits; the first one's text, for another range's last."""
    names = [c.split()[0] for c in RESULT.split(", ")] + ["part", "kind", "text"]
    held = None
    for batch in batches:
        out = []
        for part, doc_id, text in zip(batch.part, _ids(batch.doc_id), batch.text):
            own = fingerprint(text)
            if held is None:
                out.append((doc_id, None, None, own, None, None, None, part, "first", text))
            else:
                out.append((*_judged(*held[1:], text, own), held[0], "done", None))
            held = (part, doc_id, text, own)
        yield _frame(out, names)
    if held is not None:
        part, doc_id, text, own = held
        yield _frame([(doc_id, None, None, own, None, None, None, part, "last", text)], names)


def _ids(texts: pd.Series) -> list[int | None]:
    """Ids travel as texts: pandas would make a column of longs with nulls a column of doubles."""
    return [None if t is None else int(t) for t in texts]


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names, dtype="object").astype({"doc_id": "Int64", "n_chars": "Int64"})


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    order = (F.desc_nulls_last("doc_id"), F.asc("h"))
    dealt = texts.repartitionByRange(*order).sortWithinPartitions(*order, "text").select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.spark_partition_id().alias("part"))
    walked = stored(dealt.mapInPandas(_walk, f"{RESULT}, part int, kind string, text string"), "digests")
    # A number per range, which are as many as shuffle partitions at most.
    parts = [r.part for r in walked.where("kind = 'first'").select("part").orderBy("part").collect()]
    after = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, other int")
    first = walked.where("kind = 'first'").select(F.col("part").alias("other"), F.col("text").alias("following"), F.col("fingerprint").alias("theirs"))
    ends = walked.where("kind = 'last'").select("part", F.col("doc_id").cast("string").alias("doc_id"), "text", "fingerprint").join(after, "part").join(first, "other")

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_judged(*r) for r in zip(_ids(batch.doc_id), batch.text, batch.fingerprint, batch.following, batch.theirs)]
            yield _frame(rows, [c.split()[0] for c in RESULT.split(", ")])

    done = walked.where("kind = 'done'").select(*[c.split()[0] for c in RESULT.split(", ")])
    return done.unionByName(ends.select("doc_id", "text", "fingerprint", "following", "theirs").mapInPandas(finish, RESULT))
