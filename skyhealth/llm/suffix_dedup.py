"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Every suffix of every text is ordered through its first ``DEPTH`` bytes only,
by most-significant-digit passes that split groups until they are single or
equal to that depth; equal groups are exactly the repeated windows. A suffix's
first digit is a ``GRAM``-byte piece chosen by its own window (the piece of
least hash, with its offset there), so suffixes that follow one another mostly
share the piece, and one row stands for the whole run of them:

* pass 1 deals runs by that piece; a piece seen once ends there;
* pass 2 splits a piece's runs by the bytes all their windows span: runs equal
  there hold equal windows throughout, and all but the first are repeats;
* pass 3 deals the suffixes of the few runs that still share a piece by the
  rest of their window, to the full depth.

A piece with more than ``MOST_RUNS`` rows is streamed, not held: its open runs
go to pass 3 as single suffixes, dealt by piece, offset and rest together, with
those equal within an Arrow batch folded, so its suffixes spread over all tasks.

Digits are hashes of the bytes they stand for (64 bits for the piece and 52 or
64 more for the rest, compared together). Runs equal within an Arrow batch are
folded before the shuffle, so a text or passage that a third of all rows hold
reaches the sort about once per batch.

Edge cases: a null text is empty; a text shorter than ``DEPTH`` has no window;
null doc_ids come before all others (down to -2^62), in the order of a hash of
the text; rows that share a doc_id are ordered by text, equal ones one after the
other, so a repeated row is a repeat of the first;
an empty table gives no rows; extra columns are carried, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyhealth.llm.byte_hash import ByteHash
from skyhealth.llm.common import blobs, by_key, by_key_in_parts, mix64, schema_of

DEPTH = 100
GRAM = 50
#: Bytes hashed at a time; also the window starts of one piece of a longer text.
PIECE = 1 << 20
#: Rows of one piece that a task holds at a time.
MOST_RUNS = 1 << 16
LOWEST = -(1 << 63)
PLACE = (1 << 32) - 1  # low half of ``at``: position; high half: place among rows of one doc_id

RUNS = "g long, sig long, k long, at long, again boolean"
FOUND = "k long, at long, lo int, hi int, g long, open boolean"


class Slice(ByteHash):
    """Some bytes of a batch: whole texts, or one piece of a long text.
    ``docs`` and ``shift`` tell each segment's row and its first byte there."""

    def __init__(self, data: np.ndarray, docs: np.ndarray, shift: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        super().__init__(data)
        self.docs, self.shift, self.starts, self.ends = docs, shift, starts, ends

    def windows(self, depth: int) -> np.ndarray:
        """Window starts, in order."""
        count = np.maximum(self.ends - self.starts - depth + 1, 0)
        return np.repeat(self.starts - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())


def slices(data: np.ndarray, offsets: np.ndarray, depth: int, piece: int = PIECE) -> Iterator[Slice]:
    n, first = len(offsets) - 1, 0
    while first < n:
        size = offsets[first + 1] - offsets[first]
        if size > piece + depth:
            for at in range(0, size - depth + 1, piece):
                end = min(size, at + piece + depth - 1)
                yield Slice(data[offsets[first] + at:offsets[first] + end], np.array([first]), np.array([at]),
                            np.array([0]), np.array([end - at]))
            first += 1
            continue
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + piece, "right")) - 1)
        base = offsets[first]
        yield Slice(data[base:offsets[end]], np.arange(first, end), np.zeros(end - first, np.int64),
                    offsets[first:end] - base, offsets[first + 1:end + 1] - base)
        first = end


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def find_runs(part: Slice, depth: int, gram: int) -> dict[str, np.ndarray] | None:
    """Runs of window starts that share a first digit: row, digit, anchor
    position, the offsets of the anchor in its last and first window, and the
    hash of all bytes the run's windows span."""
    s = part.windows(depth)
    if not len(s):
        return None
    places = np.arange(len(part.sums) - gram)
    grams = part.hash(places, gram)
    low = np.uint64((1 << 21) - 1)
    anchor = (_least((grams & ~low) | places.astype(np.uint64), depth - gram + 1)[s] & low).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (s[1:] != s[:-1] + 1)])
    last = np.r_[first[1:], len(s)] - 1
    lo, hi, anchor = s[first], s[last], anchor[first]
    seg = np.searchsorted(part.starts, lo, "right") - 1
    return {"row": part.docs[seg], "g": grams[anchor], "at": anchor - part.starts[seg] + part.shift[seg],
            "o_lo": anchor - hi, "o_hi": anchor - lo, "span": part.hash(lo, hi - lo + depth)}


def _runs_of(depth: int, gram: int, piece: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [r for p in slices(*blobs(batch["text"]), depth, piece) if (r := find_runs(p, depth, gram))]
            if not found:
                continue
            r = {c: np.concatenate([f[c] for f in found]) for c in found[0]}
            k = batch["k"].to_numpy(zero_copy_only=False)[r["row"]]
            at = (batch["seq"].to_numpy(zero_copy_only=False).astype(np.int64)[r["row"]] << 32) | r["at"]
            ends = (r["o_lo"] << 6 | r["o_hi"]).astype(np.uint64)
            sig = (r["span"] & ~np.uint64(4095)) | ends
            # Equal runs of this batch: all but the first are repeats already.
            order = np.lexsort((at, k, sig, r["g"]))
            again = np.zeros(len(k), bool)
            again[order[1:]] = (sig[order[1:]] == sig[order[:-1]]) & (r["g"][order[1:]] == r["g"][order[:-1]])
            # They need not meet their digit's others, so they go anywhere.
            g = np.where(again, mix64(k.view(np.uint64) ^ at.view(np.uint64)), r["g"])
            yield pa.RecordBatch.from_pydict({
                "g": pa.array(g.view(np.int64)), "sig": pa.array(sig.view(np.int64)), "k": pa.array(k),
                "at": pa.array(at), "again": pa.array(again)})

    return over


def _split(depth: int, most_runs: int):
    """Pass 2 over the sorted runs: repeats, and runs still open. The lowest
    bit of an open run's digit tells whether the digit has over ``most_runs``."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for r, large in by_key_in_parts(batches, "g", ["g", "sig", "k", "at", "again"], most_runs):
            if not len(r["g"]):
                continue
            alone = r["again"].astype(bool)
            new_g = np.r_[True, r["g"][1:] != r["g"][:-1]]
            new = new_g | np.r_[True, r["sig"][1:] != r["sig"][:-1]] | alone
            if large:
                # Parts of one digit; the first row may go on with the last part's run.
                new[0] = alone[0] or (r["g"][0], r["sig"][0]) != before
                before = r["g"][-1], r["sig"][-1]
            digit = np.cumsum(new_g) - 1
            classes = np.bincount(digit[new & ~alone], minlength=digit[-1] + 1)
            is_open = new & ~alone & (large | (classes[digit] > 1))
            out = np.flatnonzero(is_open | ~new | alone)
            at, ends = r["at"][out], r["sig"][out] & 4095
            place = at & PLACE
            yield pa.RecordBatch.from_pydict({
                "k": pa.array(r["k"][out]), "at": pa.array(at),
                "lo": pa.array((place - (ends & 63)).astype(np.int32)), "hi": pa.array((place - (ends >> 6)).astype(np.int32)),
                "g": pa.array(np.where(is_open[out], r["g"][out] & -2 | large, 0)), "open": pa.array(is_open[out])})

    return over


def _singles(found: list[tuple]) -> dict[str, list | pa.Array]:
    """A batch's suffixes of large digits (digit, k, anchor, first start,
    hashes), a row each. Of equal ones all but the first are repeats already:
    they carry no hash and go anywhere."""
    count = [len(f[4]) for f in found]
    g, k, at, lo = (np.repeat(np.array(c, np.int64), count) for c in list(zip(*found))[:4])
    h = np.concatenate([f[4] for f in found])
    start = lo + np.arange(len(lo)) - np.repeat(np.r_[0, np.cumsum(count)[:-1]], count)
    key = mix64(mix64(g.view(np.uint64) ^ ((at & PLACE) - start).view(np.uint64)) ^ h)
    order = np.lexsort((at, k, key))
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    key = np.where(again, mix64(k.view(np.uint64) ^ at.view(np.uint64)), key)
    return {"g": pa.array(key.view(np.int64)), "k": pa.array(k), "at": pa.array(at), "lo": pa.array(start.astype(np.int32)),
            "hashes": pa.array([b"" if a else x.tobytes() for a, x in zip(again, h)], pa.binary())}


def _suffixes(depth: int, piece: int):
    """The full-depth hashes of the suffixes of open runs, a run a row; those
    of large digits a suffix a row."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs = batch["seq"].to_pylist()
            wanted: dict[int, list] = {}
            for d, (seq, open_runs) in enumerate(zip(seqs, batch["open_runs"].to_pylist())):
                own = [r for r in open_runs if r["at"] >> 32 == seq]
                if own:
                    wanted[d] = own
            out: dict[str, list] = {c: [] for c in ("g", "k", "at", "lo", "hashes")}
            ks = batch["k"].to_pylist()
            large: list[tuple] = []
            for part in slices(*blobs(batch["text"]), depth, piece):
                if not any(d in wanted for d in part.docs.tolist()):
                    continue
                places = np.arange(max(0, len(part.sums) - depth))
                hashes = part.hash(places, depth)
                for d, shift, start, end in zip(part.docs.tolist(), part.shift.tolist(), part.starts.tolist(), part.ends.tolist()):
                    for r in wanted.get(d, ()):
                        lo, hi = r["lo"] - shift, r["hi"] - shift
                        if lo < 0 or start + hi + depth > end:
                            continue
                        own = hashes[start + lo:start + hi + 1]
                        if r["g"] & 1:
                            large.append((r["g"], ks[d], r["at"], r["lo"], own))
                        else:
                            out["g"].append(r["g"])
                            out["k"].append(ks[d])
                            out["at"].append(r["at"])
                            out["lo"].append(r["lo"])
                            out["hashes"].append(own.tobytes())
            yield pa.RecordBatch.from_pydict({
                "g": pa.array(out["g"], pa.int64()), "k": pa.array(out["k"], pa.int64()), "at": pa.array(out["at"], pa.int64()),
                "lo": pa.array(out["lo"], pa.int32()), "hashes": pa.array(out["hashes"], pa.binary())})
            if large:
                yield pa.RecordBatch.from_pydict(_singles(large))

    return over


def _equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass 3: suffixes of one digit with equal offset and hash; all but the
    first of each group are repeats, given back as ranges of starts. A row
    without a hash is a repeat already."""
    for r in by_key(batches, "g", ["g", "k", "at", "lo", "hashes"]):
        if not len(r["g"]):
            continue
        data, offsets = blobs(r["hashes"].combine_chunks())
        count = np.diff(offsets) // 8
        h = np.frombuffer(data.tobytes(), np.uint64)
        row = np.repeat(np.arange(len(count)), count)
        start = r["lo"].astype(np.int64)[row] + np.arange(len(row)) - np.repeat(offsets[:-1] // 8, count)
        offset = (r["at"] & PLACE)[row] - start
        g = r["g"][row]
        order = np.lexsort((np.arange(len(row)), h, offset, g))
        a, b = order[1:], order[:-1]
        again = np.zeros(len(row), bool)
        again[a] = (h[a] == h[b]) & (offset[a] == offset[b]) & (g[a] == g[b])
        at = np.flatnonzero(again)
        first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])]) if len(at) else at
        last = np.r_[first[1:], len(at)] - 1 if len(at) else at
        lo, hi = at[first], at[last]
        known = np.flatnonzero(count == 0)
        rows = np.r_[row[lo], known]
        yield pa.RecordBatch.from_pydict({
            "k": pa.array(r["k"][rows]), "at": pa.array(r["at"][rows]),
            "lo": pa.array(np.r_[start[lo], r["lo"][known]].astype(np.int32)),
            "hi": pa.array(np.r_[start[hi], r["lo"][known]].astype(np.int32))})


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of [lo, hi)."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    first = np.flatnonzero(np.r_[True, lo[1:] > hi[:-1]])
    return lo[first], hi[np.r_[first[1:], len(lo)] - 1]


def _cut(depth: int, keep: list[str], with_text: bool):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = blobs(batch["text"])
            out: dict[str, list] = {c: [] for c in ("n_removed", "spans", "sha", "text")}
            for d, (seq, spans) in enumerate(zip(batch["seq"].to_pylist(), batch["spans"])):
                text = data[offsets[d]:offsets[d + 1]]
                lo, hi = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if spans.is_valid:
                    own = spans.values
                    mine = own.field("at").to_numpy() >> 32 == seq
                    if mine.any():
                        lo, hi = merged(own.field("lo").to_numpy()[mine].astype(np.int64),
                                        own.field("hi").to_numpy()[mine].astype(np.int64) + depth)
                edges = np.r_[0, np.c_[lo, hi].ravel(), len(text)].astype(np.int64)
                left = b"".join(text[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2]))
                out["n_removed"].append(int((hi - lo).sum()))
                out["spans"].append([{"first": a, "end": b} for a, b in zip(lo.tolist(), hi.tolist())])
                out["sha"].append(hashlib.sha256(left).hexdigest())
                # A character cut in two goes with its removed part.
                out["text"].append(left.decode(errors="ignore") if with_text else None)
            yield pa.RecordBatch.from_pydict({c: batch[c] for c in keep} | {
                "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(out["n_removed"], pa.int64()),
                "n_spans": pa.array([len(s) for s in out["spans"]], pa.int64()), "kept_sha256": pa.array(out["sha"], pa.string()),
                "removed": pa.array(out["spans"], pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                "kept_text": pa.array(out["text"], pa.string())})

    return over


def dedup(docs: DataFrame, with_text: bool = True, depth: int = DEPTH, gram: int = GRAM, piece: int = PIECE,
          most_runs: int = MOST_RUNS) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with n_bytes, n_removed,
    n_spans, kept_sha256, the ``removed`` byte spans, and ``kept_text`` if asked.

    One shuffle of the texts by doc_id serves the three steps that read them."""
    if not gram <= depth < gram + 64:
        raise ValueError("gram must be at most depth and over depth - 64")
    rest = [c for c in docs.columns if c != "text"]
    # Never null, so that no join filters its side and all share one shuffle.
    nobody = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(LOWEST))
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), nobody).alias("k"),
                      F.coalesce(F.col("text"), F.lit("")).alias("text"),
                      F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    base = own.withColumn("seq", F.row_number().over(W.partitionBy("k").orderBy("text")))
    found = (base.mapInArrow(_runs_of(depth, gram, piece), RUNS).repartition("g").sortWithinPartitions("g", "sig", "k", "at")
             .mapInArrow(_split(depth, most_runs), FOUND))
    open_runs = found.where("open").groupBy("k").agg(F.collect_list(F.struct("at", "g", "lo", "hi")).alias("open_runs"))
    equal = (base.join(open_runs.hint("merge"), "k").mapInArrow(_suffixes(depth, piece), "g long, k long, at long, lo int, hashes binary")
             .repartition("g").sortWithinPartitions("g", "k", "at").mapInArrow(_equal, "k long, at long, lo int, hi int"))
    spans = (found.where("not open").select("k", "at", "lo", "hi").unionByName(equal)
             .groupBy("k").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("spans")))
    schema = schema_of(own, ["row"], "n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                     "removed array<struct<first:bigint,end:bigint>>, kept_text string")
    return base.join(spans.hint("merge"), "k", "left").mapInArrow(_cut(depth, ["row"], with_text), schema)


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages cut out, columns unchanged; n_chars,
    where there is one, is counted anew."""
    found = dedup(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)
           if "n_chars" in docs.columns else None}
    return found.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (
  SELECT doc_id, p, md5(substr(x, 2 * p + 1, 200)) AS g
  FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS p FROM d)),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS n FROM w) WHERE n > 1),
gone AS (
  SELECT doc_id, p, max(p + 100) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM again),
island AS (SELECT *, sum(CASE WHEN e IS NULL OR p > e THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM gone),
span AS (SELECT doc_id, k, min(p) AS a, max(p) + 100 AS b FROM island GROUP BY 1, 2),
edge AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM span
  UNION ALL SELECT doc_id, len(x) // 2, len(x) // 2, coalesce((SELECT max(b) FROM span s WHERE s.doc_id = d.doc_id), 0) FROM d),
r AS (
  SELECT doc_id, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a, b) AS kept, sum(b - a) AS n_removed,
         sum(CASE WHEN b > a THEN 1 ELSE 0 END) AS n_spans, any_value(len(x) // 2) AS n_bytes
  FROM edge JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM r
"""
