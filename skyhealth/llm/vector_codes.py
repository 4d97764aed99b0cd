"""Compression of vectors to codes, one per part, with equal-average search.

A vector's components are floored to integers of 1/256 and cut into ``PARTS``
consecutive parts; every part position has a codebook of its own. By Cauchy and
Schwarz the squared gap of two parts' component sums, over their dimension, is
never more than their squared distance. So the entries are sorted by sum, and a
part looks outwards from its own sum until that bound strictly exceeds the best
distance found; at an equal bound it looks on, as a tie goes to the lower index.

How it runs: the codebooks (``PARTS`` x ``ENTRIES`` entries, whatever the
table) start from the first vectors. In each round workers assign the parts of
their vectors and send on counts and sums per entry, which Spark adds up; no
vector is shuffled. Codes and errors are then written once; the sum of a label
is an aggregate that meets the rows in a join.

Edge cases: vectors that are null or empty or hold a null or non-finite
component are left out, and so are those with a component of magnitude
``LARGEST`` or more, as their distances leave 64 bits, and those whose length
is not that of the first vector. A length that ``PARTS`` does not divide is
filled up with zeros. The first vectors are those of least vec_id, ties in the
order of their components; a row without vec_id is coded but starts no entry.
With fewer vectors than entries a codebook is shorter. Repeated rows are coded
and counted each; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyhealth.llm.common import staged

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Of the unscaled components; squares of a part of 1,024 of them sum to 63 bits.
LARGEST = 1 << 17
#: Components that are searched at a time, about.
CHUNK = 1 << 20


def whole(vectors: pa.Array, parts: int = PARTS) -> np.ndarray:
    """Vectors of one length as integers: vector, part, component."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(flat * SCALE).astype(np.int64).reshape(len(vectors), -1)
    return np.pad(x, ((0, 0), (0, -x.shape[1] % parts))).reshape(len(vectors), parts, -1)


class Codebook:
    """The entries of one part position, in order of their component sums."""

    def __init__(self, entries: np.ndarray):
        self.sums = entries.sum(axis=1)
        self.order = np.argsort(self.sums, kind="stable")
        self.sums, self.entries = self.sums[self.order], entries[self.order]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry to each row, the lowest of several, and
        the squared distance."""
        n, size = x.shape
        sums = x.sum(axis=1)
        start = np.searchsorted(self.sums, sums)
        best = np.full(n, np.iinfo(np.int64).max)
        index = np.full(n, len(self.sums))
        for step in (-1, 1):
            # The two ways end each by its own bound, over what is best so far.
            live = np.arange(n)
            at = start - 1 if step < 0 else start.copy()
            while len(live):
                here = at[live]
                inside = (here >= 0) & (here < len(self.sums))
                live, here = live[inside], here[inside]
                # In floating point, which a square cannot leave; the margin lets a bound that is equal pass.
                gap = (sums[live] - self.sums[here]).astype(float)
                near = gap * gap <= size * best[live].astype(float) * (1 + 1e-12)
                live, here = live[near], here[near]
                if not len(live):
                    break
                d = ((x[live] - self.entries[here]) ** 2).sum(axis=1)
                own = self.order[here]
                better = (d < best[live]) | (d == best[live]) & (own < index[live])
                won = live[better]
                best[won], index[won] = d[better], own[better]
                at[live] = here + step
        return index, best


def _assign(x: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    index = np.empty(x.shape[:2], np.int64)
    error = np.zeros(len(x), np.int64)
    for part, book in enumerate(books):
        index[:, part], d = book.nearest(x[:, part])
        error += d
    return index, error


def _chunks(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    rows = max(1, CHUNK // width)
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def _sums(codebooks: np.ndarray):
    """Count and component sums of each entry's parts; one row an entry in use."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(b) for b in codebooks]
        parts, entries, size = codebooks.shape
        count, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, size), np.int64)
        for batch in batches:
            for chunk in _chunks(batch, parts * size):
                x = whole(chunk["v"], parts)
                index, _ = _assign(x, books)
                for part in range(parts):
                    order = np.argsort(index[:, part], kind="stable")
                    used, first, n = np.unique(index[order, part], return_index=True, return_counts=True)
                    count[part * entries + used] += n
                    sums[part * entries + used] += np.add.reduceat(x[order, part], first)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({
            "slot": pa.array(used.astype(np.int32)), "n": pa.array(count[used]),
            "sums": pa.array(list(sums[used]), pa.list_(pa.int64()))})

    return over


def _codes(codebooks: np.ndarray):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(b) for b in codebooks]
        hexes = np.array([f"{i:02x}" for i in range(codebooks.shape[1])], object)
        for batch in batches:
            for chunk in _chunks(batch, codebooks.shape[0] * codebooks.shape[2]):
                index, error = _assign(whole(chunk["v"], codebooks.shape[0]), books)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": chunk["vec_id"], "label": chunk["label"],
                    "code": pa.array(["".join(r) for r in hexes[index]], pa.string()), "error": pa.array(error)})

    return over


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and ``v`` (the vector) of the rows that can be coded, but
    for their length."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= F.lit(float(LARGEST))))
    rows = vectors.select("vec_id", "label", v.alias("v"), bad.alias("bad"), F.size(v).alias("n"))
    return rows.where((F.col("n") > 0) & ~F.col("bad")).select("vec_id", "label", "v", "n")


def fit(rows: DataFrame, first: list, parts: int = PARTS, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) from the entries' ``first`` vectors
    after some rounds over all rows."""
    codebooks = whole(pa.array(first, pa.list_(pa.float64())), parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        found = rows.select("v").mapInArrow(_sums(codebooks), "slot int, n long, sums array<long>")
        size = codebooks.shape[2]
        # One row an entry of a codebook comes back, at most.
        found = found.groupBy("slot").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(size)]).alias("sums"))
        for slot, n, sums in found.collect():
            codebooks[slot // codebooks.shape[1], slot % codebooks.shape[1]] = np.array(sums, np.int64) // n
    return codebooks


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label, label_error and codebooks_sha256 of every
    vector that can be coded."""
    rows = usable(vectors)
    first = [r.v for r in rows.where("vec_id IS NOT NULL").orderBy("vec_id", "v").limit(entries).collect()]
    if not first:  # every vector lacks its vec_id, or there is none
        first = [r.v for r in rows.orderBy("v").limit(entries).collect()]
    length = len(first[0]) if first else 0
    rows = rows.where(F.col("n") == length)
    codebooks = fit(rows, [v for v in first if len(v) == length], parts, rounds) if first else np.zeros((parts, 0, 1), np.int64)
    coded = staged(rows.select("vec_id", "label", "v").mapInArrow(
        _codes(codebooks), vectors.select("vec_id", "label").schema.add("code", "string").add("error", "long")), "codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    # No hint: labels that prove few are broadcast, else the join is merged, with its skew split.
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))


def _round(n: int, books: str) -> str:
    """SQL of one assignment: the nearest entry of each part."""
    return f"""
a{n} AS (
  SELECT rid, part, min(struct_pack(d := d, entry := entry)) AS best FROM (
    SELECT x.rid, x.part, b.entry, list_sum(list_transform(list_zip(x.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM x JOIN {books} b ON x.part = b.part)
  GROUP BY 1, 2)"""


def _update(n: int, books: str) -> str:
    return f"""
b{n + 1} AS (
  SELECT b.part, b.entry, coalesce(u.c, b.c) AS c FROM {books} b LEFT JOIN (
    SELECT part, entry, list(CAST(CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END AS BIGINT) ORDER BY pos) AS c FROM (
      SELECT part, entry, pos, sum(val) AS s, count(*) AS n FROM (
        SELECT x.part, best.entry AS entry, unnest(range(1, len(x.c) + 1)) AS pos, unnest(x.c) AS val
        FROM x JOIN a{n} USING (rid, part))
      GROUP BY 1, 2, 3)
    GROUP BY 1, 2) u ON u.part = b.part AND u.entry = b.entry)"""


SQL = f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
         list_transform(embedding, lambda e: CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS (
  SELECT rid, part, c[part * (len(c) // {PARTS}) + 1 : (part + 1) * (len(c) // {PARTS})] AS c
  FROM (SELECT rid, c, unnest(range({PARTS})) AS part FROM v)),
b0 AS (SELECT part, rid - 1 AS entry, c FROM x WHERE rid <= {ENTRIES}),
{_round(0, "b0")},{_update(0, "b0")},{_round(1, "b1")},{_update(1, "b1")},{_round(2, "b2")},
e AS (
  SELECT rid, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a2 GROUP BY 1),
s AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, label, codebooks_sha256
FROM v JOIN e USING (rid), s
"""
