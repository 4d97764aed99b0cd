"""Benchmark decontamination.

The benchmark's normalised word windows are a hash set. It is read in blocks of
bounded text; a block is broadcast, one pass over the documents looks every
window of known words up in it, verifies hits word by word, and writes the
words hit, and the broadcast is destroyed before the next. So neither the
driver nor a worker ever holds more than a block, whatever the benchmark's
size. Hits are kept by a digest of the text, as they depend on it alone; the
documents meet them in a join at the end, which moves no text unless asked to.

Edge cases: a null text has no words, so no hits; an empty benchmark hits
nothing; a null ``item_id`` counts as the empty string; rows repeated in either
table are judged (documents) or merged by ``item_id`` (items); a very long text
is scanned whole, in windows of a slice at a time; an empty table of documents
gives no rows; only the columns named here are read, so extra columns cannot
clash.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyhealth.llm.common import ASCII_LOWER, packed, schema_of, small, staged, unpacked

WINDOW = 13
#: Words keep ASCII letters, digits and every non-ASCII character.
_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
NORMAL = bytes(b if b in _KEEP else 32 for b in ASCII_LOWER)
#: Benchmark text of one broadcast block, about; twice that at most, or one item.
BLOCK_BYTES = 2 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(NORMAL).split() if text else []


class Windows:
    """The window hash set of one benchmark block: the distinct windows of each
    length as rows of word ids, and the items that each occurs in."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        found: dict[int, list] = {}
        for item, (_, text) in enumerate(items):
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)], np.int32)
            size = min(window, len(ids))
            if size:
                rows = np.lib.stride_tricks.sliding_window_view(ids, size)
                found.setdefault(size, []).append((rows, np.full(len(rows), item, np.int32)))
        self.names = [name for name, _ in items]
        self.by_size = {}
        for size, parts in found.items():
            rows, item = (np.concatenate(x) for x in zip(*parts))
            hashes = self.hash(rows)
            order = np.lexsort((item, *rows.T[::-1], hashes))
            rows, item, hashes = rows[order], item[order], hashes[order]
            first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)])
            self.by_size[size] = hashes[first], rows[first], np.r_[first, len(rows)], item

    @staticmethod
    def hash(rows: np.ndarray) -> np.ndarray:
        h = np.zeros(len(rows), np.uint64)
        for j in range(rows.shape[1]):
            h = (h ^ rows[:, j].astype(np.uint64)) * MIX
            h ^= h >> np.uint64(29)
        return h

    def scan(self, ids: np.ndarray) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, size, items) of every window that occurs in ``ids``,
        where 0 stands for an unknown word or a document's end."""
        gaps = np.flatnonzero(ids == 0)
        known = np.diff(np.r_[-1, gaps, len(ids)]) - 1
        starts = np.r_[0, gaps + 1]
        for size, (hashes, rows, first, item) in self.by_size.items():
            long = known >= size
            if not long.any():
                continue
            count = known[long] - size + 1
            at = np.repeat(starts[long] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            # In slices, so the window matrix stays small whatever the batch.
            for part in np.array_split(at, max(1, len(at) >> 18)):
                seen = ids[part[:, None] + np.arange(size)]
                h = self.hash(seen)
                pos = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                near = hashes[pos] == h
                # Equal hashes of different windows stand side by side.
                for i in np.flatnonzero(near):
                    k = pos[i]
                    while k < len(hashes) and hashes[k] == h[i]:
                        if (rows[k] == seen[i]).all():
                            yield int(part[i]), size, sorted({self.names[j] for j in item[first[k]:first[k + 1]]})
                        k += 1


@functools.lru_cache(maxsize=1)
def _windows(block: Broadcast, window: int) -> Windows:
    """A worker builds a block's hash set once and holds one at a time."""
    return Windows(block.value, window)


def digest(text: str | None) -> bytes:
    return hashlib.sha256((text or "").encode()).digest()


HITS = "digest binary, n_words long, hits array<struct<first:int,end:int>>, items array<string>"


def _hits(block: Broadcast, window: int):
    """The words of a text hit by a block, as spans, with the items; texts
    that have any."""
    span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _windows(block, window)
        get = own.vocab.get
        for batch in small(batches):
            texts = batch["text"].to_pylist()
            ids, first = [], [0]
            for text in texts:
                ids.extend([get(w, 0) for w in words_of(text)])
                ids.append(0)
                first.append(len(ids))
            ids, first = np.array(ids, np.int32), np.array(first)
            spans: dict[int, list] = {}
            named: dict[int, set] = {}
            for at, size, items in own.scan(ids):
                doc = int(np.searchsorted(first, at, "right")) - 1
                spans.setdefault(doc, []).append((at - int(first[doc]), at - int(first[doc]) + size))
                named.setdefault(doc, set()).update(items)
            yield pa.RecordBatch.from_pydict({
                "digest": pa.array([digest(texts[d]) for d in spans], pa.binary()),
                "n_words": pa.array([int(first[d + 1] - first[d]) - 1 for d in spans], pa.int64()),
                "hits": pa.array([[{"first": a, "end": b} for a, b in merged(s)] for s in spans.values()], span),
                "items": pa.array([sorted(named[d]) for d in spans], pa.list_(pa.string()))})

    return over


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and adjoining spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _counted(keep: list[str]):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = batch["text"].to_pylist()
            yield pa.RecordBatch.from_pydict({c: batch[c] for c in keep} | {
                "n_words": pa.array([len(words_of(t)) for t in texts], pa.int64()), "digest": pa.array(list(map(digest, texts)), pa.binary())})

    return over


def benchmark_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The items in blocks of about ``block_bytes`` of text, one at a time: the
    number of blocks grows until the largest holds twice that at most, or
    little more than the largest item."""
    sizes = items.agg(F.sum(F.octet_length("text")).alias("b"), F.max(F.octet_length("text")).alias("most")).first()
    if sizes.b is None:
        return
    n, most = 1 + sizes.b // block_bytes, max(2 * block_bytes, sizes.most + block_bytes)
    while True:
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
        if items.groupBy(block.alias("block")).agg(F.sum(F.octet_length("text")).alias("b")).where(F.col("b") > most).isEmpty():
            break
        n *= 2
    for b in range(n):
        rows = [(r.item_id, r.text) for r in items.where(block == b).select("item_id", "text").distinct().collect()]
        if rows:
            yield rows


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """digest, n_words, hits and items (sorted) of every text with a hit, a written table."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").where("text IS NOT NULL")
    found = spark.createDataFrame([], HITS)
    for rows in benchmark_blocks(items, block_bytes):
        block = spark.sparkContext.broadcast(rows)
        # Copies of a text within a task are one row; of one text in two tasks, below.
        one = docs.select("text").mapInArrow(_hits(block, window), HITS)
        found = found.unionByName(staged(one, "hits"))
        block.destroy()
    # Adjoining spans meet again where blocks are put together.
    spans = F.array_sort(F.array_distinct(F.flatten(F.collect_set("hits"))))
    last = lambda a: F.element_at(a, -1)                                  # noqa: E731
    meet = lambda a, s: F.when((F.size(a) > 0) & (s["first"] <= last(a)["end"]), F.concat(                 # noqa: E731
        F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(last(a)["first"].alias("first"), F.greatest(last(a)["end"], s["end"]).alias("end"))))
    ).otherwise(F.concat(a, F.array(s)))
    whole = F.aggregate(spans, F.array().cast("array<struct<first:int,end:int>>"), meet)
    return staged(found.groupBy("digest").agg(F.max("n_words").alias("n_words"), whole.alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")), "found")


def words_hit(hits: Column) -> Column:
    return F.aggregate(hits, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"])


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def judge(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every document with its ``keep`` columns, the contract's digest columns,
    the word spans hit and the items found. ``keep`` may hold ``text``."""
    found = find(docs, benchmark, window, block_bytes).drop("n_words").withColumnsRenamed({"digest": "__digest", "hits": "__hits", "items": "__items"})
    own = packed(docs.select(*dict.fromkeys([*keep, "text"])))
    counted = own.select("row", "text").mapInArrow(_counted(["row"]), schema_of(own, ["row"], "n_words long, digest binary"))
    # No hint: a table of hits that its files show to be small is broadcast.
    c = F.col
    out = counted.join(found, c("digest") == c("__digest"), "left")
    hits = F.coalesce(c("__hits"), F.array().cast("array<struct<first:int,end:int>>"))
    items = F.coalesce(c("__items"), F.array().cast("array<string>"))
    n_hit = words_hit(hits)
    return out.select(*[c(f"row.`{k}`").alias(k) for k in keep], "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                      contaminated(n_hit, c("n_words")).alias("contaminated"), hits.alias("hits"), items.alias("items"))


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without the contaminated ones, columns unchanged."""
    found = find(docs, benchmark, window)
    bad = found.where(contaminated(words_hit(F.col("hits")), F.col("n_words"))).select(F.col("digest").alias("__digest"))
    # Digests in the JVM: the kept texts do not pass through Python again.
    own = packed(docs)
    same = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)) == F.col("__digest")
    return unpacked(own.join(bad, same, "left_anti"), docs.columns)


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(list_slice(w, p, p + least(13, len(w)) - 1), ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, size, p, array_to_string(list_slice(w, p, p + size - 1), ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
        FROM d, (SELECT DISTINCT size FROM iw) WHERE len(w) >= size)),
hit AS (SELECT doc_id, p, size, item_id FROM dw JOIN iw USING (size, gram)),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hit) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""
