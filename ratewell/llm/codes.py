"""Vector codes: product quantisation over integers, nearest entries found with a GNAT over each codebook.

Components become floor(1024 * x). A vector is cut into PARTS equal parts, each with a codebook of up to ENTRIES entries,
which starts as the parts of the smallest ids and moves to the floored means of its vectors ROUNDS times. A task sums its
vectors per entry; these sums, as many as a codebook has entries, meet in one aggregation.

The GNAT keeps far-apart entries of a set as split points, deals the others to the nearest one, and notes for every split
point and subtree the range of their distances. A query measures its distance to the split points; a subtree whose range
is out of its best distance's reach is left out, strictly, with distances rounded against leaving out. What is left is
compared by exact integer squared distances, and ties go to the lower index, so the result is that of a full comparison.

Rows with a null vector or a null or non-finite component are dropped. The length of the vector with the smallest id (null
ids come last, then the smaller vector) among lengths that can be cut into equal parts holds for all; vectors of another
length are kept with null code and errors. Repeated rows count as often as they stand there. Fewer vectors than entries: a
smaller codebook. Integers beyond double precision are computed as Python integers, for components of up to 10^24; an error
that fits no long is null, and so is its label's sum. No rows: no rows. Only the three columns named by the parameters are
read, so other columns can have any name."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import one_blas_thread, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
SPLITS, LEAF = 16, 8
#: Label sums of up to so many labels are broadcast; beyond, rows of a label are salted.
LABELS, SALTS = 100_000, 32
_WIDER = 1 + 2.0 ** -50


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows: in doubles where no sum leaves their integers, else in Python integers."""
    top = max((float(np.abs(x).max()) for x in (a, b) if x.size), default=0.0)
    if a.dtype != object and b.dtype != object and a.shape[1] * (2 * top) ** 2 < 2.0 ** 53:
        return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T)).astype(np.int64)
    a, b = _integers(a), _integers(b)
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1)


def _integers(x: np.ndarray) -> np.ndarray:
    return x if x.dtype == object else np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


def _root(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64))


class Gnat:
    """A geometric near-neighbour access tree over some rows of a codebook."""

    def __init__(self, book: np.ndarray, at: np.ndarray | None = None):
        at = np.arange(len(book)) if at is None else at
        self.book, self.children = book, []
        if len(at) <= LEAF:
            self.splits = at
            return
        chosen, far = [0], squared(book[at], book[at[:1]])[:, 0]
        while len(chosen) < min(SPLITS, len(at) // 2):
            chosen.append(int(far.argmax()))
            far = np.minimum(far, squared(book[at], book[at[chosen[-1:]]])[:, 0])
        self.splits = np.sort(at[chosen])
        rest = np.setdiff1d(at, self.splits)
        d2 = squared(book[rest], book[self.splits])
        home, d = d2.argmin(axis=1), _root(d2)
        for k in range(len(self.splits)):
            if (home == k).any():
                self.children.append((k, d[home == k].min(axis=0) / _WIDER, d[home == k].max(axis=0) * _WIDER, Gnat(book, rest[home == k])))

    def search(self, q: np.ndarray, rows: np.ndarray, best: np.ndarray, entry: np.ndarray) -> None:
        """Improves best (squared distances) and entry (their lowest index) of the given rows of q."""
        if not len(rows):
            return
        d2 = squared(q[rows], self.book[self.splits])
        nearest = d2.argmin(axis=1)
        least, index = d2[np.arange(len(rows)), nearest], self.splits[nearest]
        better = (entry[rows] < 0) | (least < best[rows]) | ((least == best[rows]) & (index < entry[rows]))
        best[rows[better]], entry[rows[better]] = least[better], index[better]
        if not self.children:
            return
        d = _root(d2)
        for k, _, _, child in self.children:
            child.search(q, rows[nearest == k], best, entry)
        for k, low, high, child in self.children:
            gap = np.maximum(d / _WIDER - high, low - d * _WIDER).max(axis=1)
            near = (nearest != k) & ~(gap / _WIDER > _root(best[rows]) * _WIDER)
            child.search(q, rows[near], best, entry)

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best, entry = np.zeros(len(q), object if q.dtype == object else np.int64), np.full(len(q), -1)
        if q.dtype != object and (best_type := squared(q[:1], self.book[:1]).dtype) != best.dtype:
            best = best.astype(best_type)
        self.search(q, np.arange(len(q)), best, entry)
        return entry, best


def whole_vectors(column: pa.Array, dims: int) -> np.ndarray:
    """The valid vectors of a list column as rows of floored components: doubles that hold integers, or Python integers."""
    v = np.floor(np.asarray(column.flatten(), np.float64).reshape(-1, dims) * SCALE)
    return v if v.size == 0 or dims * (4 * np.abs(v).max()) ** 2 < 2.0 ** 53 else _integers(v)


def means(kept: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one more round."""
    trees, width = [Gnat(b) for b in books], books[0].shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_blas_thread()
        total = [np.zeros(b.shape, object) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            v = whole_vectors(batch.column(0), width * len(books))
            for p, tree in enumerate(trees):
                q = v[:, p * width:(p + 1) * width]
                entry, _ = tree.nearest(q)
                count[p] += np.bincount(entry, minlength=len(books[p]))
                if q.dtype == object:
                    np.add.at(total[p], entry, q)
                else:  # sums of a batch stay far inside a double's integers
                    total[p] += np.stack([np.bincount(entry, q[:, j], len(books[p])) for j in range(width)], axis=1).astype(np.int64)
        rows = [(p, e, int(count[p][e]), [Decimal(int(x)) for x in total[p][e]]) for p in range(len(books)) for e in np.flatnonzero(count[p])]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["part", "entry", "n", "s"])

    each = kept.select("v").mapInArrow(sums, "part int, entry int, n long, s array<decimal(38,0)>")
    added = each.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[j]) for j in range(width)]).alias("s"))
    new = [b.copy() for b in books]
    for r in added.collect():  # one row for each entry of the codebooks
        row = [int(x) // r.n for x in r.s]
        if new[r.part].dtype != object and max(map(abs, row)) >= 2 ** 53:
            new[r.part] = _integers(new[r.part])
        new[r.part][r.entry] = row
    return new


def codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """kept: vec_id, v, of any lengths. No codebooks if no length can be cut into equal parts."""
    fit = kept.where((F.size("v") > 0) & (F.size("v") % parts == 0)).withColumn("size", F.size("v"))
    order = (F.asc_nulls_last("vec_id"), F.asc("v"))
    first = fit.orderBy(*order).select("size").first()
    if first is None:
        return []
    own = fit.where(F.col("size") == first["size"])
    seeds = own.orderBy(*order).limit(entries).select("v").collect()
    start = whole_vectors(pa.array([r.v for r in seeds], pa.list_(pa.float64())), first["size"])
    width = first["size"] // parts
    books = [start[:, p * width:(p + 1) * width] for p in range(parts)]
    for _ in range(rounds):
        books = means(own, books)
    return books


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def encode(kept: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """The columns of kept but v, code, error."""
    trees, dims = [Gnat(b) for b in books], sum(b.shape[1] for b in books)
    width = dims // len(books) if books else 0

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_blas_thread()
        for batch in batches:
            at = batch.schema.get_field_index("v")
            there = np.asarray(batch.column(at).is_valid())
            codes, errors = np.full(len(there), None, object), np.full(len(there), None, object)
            if there.any():
                v = whole_vectors(batch.column(at), dims)
                found = [tree.nearest(v[:, p * width:(p + 1) * width]) for p, tree in enumerate(trees)]
                codes[there] = ["".join(f"{e:02x}" for e in row) for row in zip(*(e for e, _ in found))]
                errors[there] = [error if (error := sum(map(int, row))) < 2 ** 63 else None for row in zip(*(d for _, d in found))]
            others = [k for k in range(batch.num_columns) if k != at]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in others], pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                [*[batch.schema.names[k] for k in others], "code", "error"])

    fits = kept.withColumn("v", F.when(F.size("v") == dims, F.col("v")) if books else F.lit(None).cast(kept.schema["v"].dataType))
    schema = T.StructType([*[f for f in kept.schema.fields if f.name != "v"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return fits.mapInArrow(coded, schema)


def with_label_error(rows: DataFrame) -> DataFrame:
    """rows with the sum of their errors over equal labels; null labels are one."""
    total = F.when(F.count("error") == F.count("*"), F.sum(F.col("error").cast("decimal(38,0)")))
    totals = stored(rows.groupBy("label").agg(total.alias("t")).select(F.col("label").alias("of"), F.expr("try_cast(t AS long)").alias("label_error")), "label-errors")
    if totals.limit(LABELS + 1).count() <= LABELS:
        return rows.join(F.broadcast(totals), F.col("label").eqNullSafe(F.col("of"))).drop("of")
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("lot", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, F.col("label").eqNullSafe(F.col("of")) & (F.col("lot") == F.col("salt"))).drop("of", "salt", "lot")


def vector_codes(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row with a whole vector."""
    v = F.col(embedding)
    whole = rows.where(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    kept = whole.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), v.cast("array<double>").alias("v"))
    books = codebooks(kept.select("vec_id", "v"))
    coded = stored(encode(kept, books), "vector-codes")
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


_ASSIGN = """
near{r} AS MATERIALIZED (
  SELECT rid, p, e, CAST(d AS BIGINT) AS d FROM (
    SELECT s.rid, s.p, b.e, s.q2 + b.c2 - 2 * list_dot_product(s.q, b.c) AS d,
           row_number() OVER (PARTITION BY s.rid, s.p ORDER BY s.q2 + b.c2 - 2 * list_dot_product(s.q, b.c), b.e) AS n
    FROM subs s JOIN book{r} b ON b.p = s.p) WHERE n = 1)"""
_MOVE = """
mean{r} AS MATERIALIZED (
  SELECT p, e, list(m ORDER BY k) AS c FROM (
    SELECT p, e, k, floor(sum(x) / count(*)) AS m FROM (
      SELECT s.p, a.e, unnest(s.q) AS x, generate_subscripts(s.q, 1) AS k FROM subs s JOIN near{r} a ON a.rid = s.rid AND a.p = s.p)
    GROUP BY p, e, k) GROUP BY p, e),
book{n} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c, list_dot_product(coalesce(m.c, b.c), coalesce(m.c, b.c)) AS c2
  FROM book{r} b LEFT JOIN mean{r} m ON m.p = b.p AND m.e = b.e)"""
#: For ids that are there and differ, and vectors of one length that can be cut into four.
CODES_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
cut AS MATERIALIZED (
  SELECT rid, p, list_slice(v, p * (len(v) // {PARTS}) + 1, (p + 1) * (len(v) // {PARTS})) AS q FROM kept, range({PARTS}) t(p)),
subs AS MATERIALIZED (SELECT rid, p, q, list_dot_product(q, q) AS q2 FROM cut),
book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, q AS c, q2 AS c2 FROM subs WHERE rid <= {ENTRIES}),
""" + ",".join(_ASSIGN.format(r=r) + (("," + _MOVE.format(r=r, n=r + 1)) if r < ROUNDS else "") for r in range(ROUNDS + 1)) + f""",
coded AS (
  SELECT k.vec_id, any_value(k.label) AS label, string_agg(format('{{:02x}}', a.e), '' ORDER BY a.p) AS code, CAST(sum(a.d) AS BIGINT) AS error
  FROM kept k JOIN near{ROUNDS} a ON a.rid = k.rid GROUP BY k.rid, k.vec_id),
digest AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, k)) AS codebooks_sha256
  FROM (SELECT p, e, CAST(unnest(c) AS BIGINT) AS x, generate_subscripts(c, 1) AS k FROM book{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, digest
"""
