"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; each decision has a context tree over the
``DEPTH`` bytes before it, and every node of that tree a Krichevsky-Trofimov
estimate. A node's weighted probability is half its own estimate's and half the
product of its children's, so a prediction mixes the estimates of all depths by
how well each has coded the training text. The tree is the whole one: no node
is pruned and none is capped.

How it runs: training counts of all (context, byte) strings are summed by Spark
(one aggregate, no text moves). The trees below each two-byte context are
solved side by side; the two depths above have at most 65,280 nodes, which are
summed by Spark and solved on the driver. To score, documents are dealt into
blocks of about ``BLOCK_BYTES``; each block asks for its distinct strings and
words, a join answers, and the answers meet the block's texts in a cogroup. So
no model is broadcast, and what moves grows with the text.

Texts are scored with A-Z lower-cased, as bytes, with one end symbol (byte 0);
a text starts in a context of byte 0. Words are counted by a 64-bit hash.

Edge cases: a null text is empty and costs its end symbol; a null doc_id is not
held out; without training rows every symbol costs eight bits and every count
is 0; repeated rows are counted and scored each; a text longer than a
block is a block of its own; an empty table gives no rows; only the named columns
are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyhealth.llm.byte_hash import ByteHash
from skyhealth.llm.common import ASCII_LOWER, blobs, by_key, groups_of_docs, mix64, runs, staged

#: Context bytes; a string of them and the byte they predict fits 64 bits.
DEPTH = 5
#: Depth of the contexts whose trees are solved apart.
ROOT = 2
FOLDS, HELD_OUT = 5, 1
BLOCK_BYTES = 40 << 20
#: Text whose strings a worker holds at a time.
GROUP_BYTES = 1 << 18
#: Distinct numbers a worker adds before it folds them.
FOLD = 1 << 18
_LOWER = np.frombuffer(ASCII_LOWER, np.uint8)
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def strings(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (context, byte) string of every symbol, ends included, as numbers
    with the predicted byte lowest; and the documents' offsets among them."""
    n = len(offsets) - 1
    padded = np.zeros(len(data) + n * (DEPTH + 1), np.uint64)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    padded[np.arange(len(data)) + (doc + 1) * DEPTH + doc] = data
    key = np.zeros(len(padded) - DEPTH, np.uint64)
    for i in range(DEPTH + 1):
        key = key << np.uint64(8) | padded[i:len(padded) - DEPTH + i]
    # Each document has its length plus one symbols, DEPTH places apart.
    ends = offsets + np.arange(n + 1)
    at = np.arange(ends[-1]) + DEPTH * np.repeat(np.arange(n), np.diff(ends))
    return key[at], ends


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, and the documents' offsets among the words."""
    space = _SPACE[data]
    new = np.zeros(len(data) + 1, bool)
    new[offsets] = True
    before = np.r_[True, space[:-1]] | new[:-1] if len(data) else space
    starts = np.flatnonzero(~space & before)
    stops = np.r_[space[1:], True] | new[1:] if len(data) else space
    ends = np.flatnonzero(~space & stops) + 1
    return ByteHash(data).hash(starts, ends - starts), np.searchsorted(starts, offsets)


def _groups(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Lower-cased bytes of some documents at a time: first, end, data, offsets."""
    data, offsets = blobs(texts)
    for first, end in groups_of_docs(offsets, GROUP_BYTES):
        yield first, end, _LOWER[data[offsets[first]:offsets[end]]], offsets[first:end + 1] - offsets[first]


class Counts:
    """Training counts of distinct numbers, folded now and then. A number of
    held-out rows alone stays with count 0."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.folded = 0

    def add(self, keys: np.ndarray, train: np.ndarray) -> None:
        for chosen, weight in ((keys[train], 1), (keys[~train], 0)):
            if len(chosen):
                k, n = np.unique(chosen, return_counts=True)
                self.parts.append((k, n * weight))
                self.size += len(k)
        if self.size > 1.5 * self.folded + FOLD:
            self.fold()

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        k, n = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(k, kind="stable")
        first = runs(k[order])
        self.parts = [(k[order][first], np.add.reduceat(n[order], first))]
        self.size = self.folded = len(first)
        return self.parts[0]


def _count_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = Counts()
    for batch in batches:
        train = ~batch["held_out"].to_numpy(zero_copy_only=False)
        for first, end, data, offsets in _groups(batch["text"]):
            keys, at = strings(data, offsets)
            own.add(keys, np.repeat(train[first:end], np.diff(at)))
    keys, n = own.fold()
    for i in range(0, len(keys), 1 << 16):
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys[i:i + (1 << 16)].view(np.int64)), "n": pa.array(n[i:i + (1 << 16)])})


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct strings (word false) and words (word true) per block, with the
    block's training count (of words; strings are counted already). The rows
    come sorted by block, so one block's numbers are held at a time."""
    block, both = None, (Counts(), Counts())
    for batch in batches:
        train = ~batch["held_out"].to_numpy(zero_copy_only=False)
        blocks = batch["block"].to_numpy(zero_copy_only=False)
        first_rows = runs(blocks)
        for start, stop in zip(first_rows, [*first_rows[1:], len(blocks)]):
            if blocks[start] != block:
                yield from _asked(block, both)
                block, both = int(blocks[start]), (Counts(), Counts())
            for first, end, data, offsets in _groups(batch["text"].slice(start, stop - start)):
                both[0].add(strings(data, offsets)[0], np.zeros(offsets[-1] + end - first, bool))
                keys, at = words(data, offsets)
                both[1].add(keys, np.repeat(train[start + first:start + end], np.diff(at)))
    yield from _asked(block, both)


def _asked(block: int | None, both: tuple[Counts, Counts]) -> Iterator[pa.RecordBatch]:
    for word, counts in enumerate(both):
        keys, n = counts.fold()
        for i in range(0, len(keys), 1 << 16):
            k = keys[i:i + (1 << 16)]
            yield pa.RecordBatch.from_pydict({
                "word": pa.array(np.full(len(k), bool(word))), "key": pa.array(k.view(np.int64)),
                "block": pa.array(np.full(len(k), block, np.int32)), "n": pa.array(n[i:i + (1 << 16)])})


# --- the trees -------------------------------------------------------------

def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of n0 zeros, n1 ones."""
    half = log_gamma(0.5)
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - 2 * half - log_gamma(n0 + n1 + 1.0)


def log_gamma(x: np.ndarray | float) -> np.ndarray:
    """Stirling's series after moving the argument past 8."""
    x = np.asarray(x, float)
    move = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        move += np.where(low, np.log(y), 0.0)
        y = np.where(low, y + 1, y)
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - move


def share(log_ratio: np.ndarray) -> np.ndarray:
    """Weight of a node's own estimate against its children's."""
    return 1 / (1 + np.exp(-np.clip(log_ratio, -700, 700)))


class Forest:
    """The trees below some two-byte contexts, from all their strings. Depths
    are solved from the deepest up, and a prediction mixes them in that order,
    so of every depth only what the next one needs is held."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, predict: bool):
        keys = keys.view(np.uint64)
        # Contexts with the nearest byte first, so a shorter one is a prefix.
        turned = np.zeros(len(keys), np.uint64)
        for i in range(1, DEPTH + 1):
            turned = turned << np.uint64(8) | (keys >> np.uint64(8 * i)) & np.uint64(255)
        self.byte = (keys & np.uint64(255)).astype(np.int64)
        self.context = turned.astype(np.int64)
        #: Probability of each string's j-th decision, mixed down to ROOT.
        self.mixed = [np.zeros(len(keys)) for _ in range(8)] if predict else []
        #: The two-byte nodes: node, zeros, ones and log of the weighted probability.
        self.roots: list[tuple[np.ndarray, ...]] = []
        below: list = [None] * 8
        for depth in range(DEPTH, ROOT - 1, -1):
            prefix = self.context >> 8 * (DEPTH - depth)
            pair = prefix << 8 | self.byte
            order = np.argsort(pair, kind="stable")
            first = runs(pair[order])
            pair, count = pair[order][first], np.add.reduceat(n[order], first) if len(first) else n
            byte, context = pair & 255, pair >> 8
            for j in range(8):
                node = context << 8 | byte >> (8 - j)
                first = runs(node)
                one = np.add.reduceat(count * (byte >> (7 - j) & 1), first) if len(first) else count
                zero = (np.add.reduceat(count, first) if len(first) else count) - one
                node, own = node[first], log_kt(zero, one)
                if depth == DEPTH:
                    weight, total = np.ones(len(node)), own
                else:
                    child, log_p = below[j]
                    parent = (child >> 16) << 8 | child & 255
                    rest = np.bincount(np.searchsorted(node, parent), log_p, len(node))
                    weight, total = share(own - rest), np.logaddexp(own, rest) - np.log(2)
                below[j] = node, total
                if depth == ROOT:
                    self.roots.append((node, zero, one, total))
                if predict:
                    at = np.searchsorted(node, prefix << 8 | self.byte >> (8 - j))
                    p = ((one + 0.5) / (zero + one + 1))[at]
                    self.mixed[j] = mix(weight[at], np.where(self.byte >> (7 - j) & 1, p, 1 - p), self.mixed[j])

    def tops(self) -> dict[str, np.ndarray]:
        """What the two-byte nodes pass up, by (nearest byte, node of 255)."""
        out: dict[str, list] = {c: [] for c in ("byte", "node", "n0", "n1", "log_p")}
        for j, (node, zero, one, total) in enumerate(self.roots):
            out["byte"].append(node >> 16)
            out["node"].append((1 << j) | node & 255)
            out["n0"].append(zero)
            out["n1"].append(one)
            out["log_p"].append(total)
        return {c: np.concatenate(v) for c, v in out.items()}

    def log10(self, top: tuple[np.ndarray, ...]) -> np.ndarray:
        """log10 of each string's last byte in its context."""
        one1, weight1, one0, weight0 = top
        nearest = self.context >> 8 * (DEPTH - 1)
        out = np.zeros(len(self.byte))
        for j in range(8):
            bit, p = self.byte >> (7 - j) & 1, self.mixed[j]
            at = (1 << j) | self.byte >> (8 - j)
            for one, weight in ((one1[nearest, at], weight1[nearest, at]), (one0[at], weight0[at])):
                p = mix(weight, np.where(bit, one, 1 - one), p)
            out += np.log10(p)
        return out


def mix(weight: np.ndarray, own: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    return weight * own + (1 - weight) * deeper


def solve_top(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Estimates and weights of the nodes at depths 1 and 0 (arrays by nearest
    byte and node; by node)."""
    n0, n1, rest = np.zeros((256, 256)), np.zeros((256, 256)), np.zeros((256, 256))
    at = rows["byte"].to_numpy(int), rows["node"].to_numpy(int)
    n0[at], n1[at], rest[at] = rows["n0"], rows["n1"], rows["log_p"]
    own = log_kt(n0, n1)
    log_p = np.logaddexp(own, rest) - np.log(2)
    below = log_p.sum(axis=0)
    a0, a1 = n0.sum(axis=0), n1.sum(axis=0)
    return (n1 + 0.5) / (n0 + n1 + 1), share(own - rest), (a1 + 0.5) / (a0 + a1 + 1), share(log_kt(a0, a1) - below)


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for r in by_key(batches, "root", ["key", "n"]):
        yield pa.RecordBatch.from_pydict({c: pa.array(v) for c, v in Forest(r["key"], r["n"], False).tops().items()})


def _log_probabilities(top: tuple[np.ndarray, ...]):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in by_key(batches, "root", ["key", "n"]):
            # Single precision: a string's digits beyond it only cost shuffle.
            value = Forest(r["key"], r["n"], True).log10(top).astype(np.float32).astype(float)
            yield pa.RecordBatch.from_pydict({"key": pa.array(r["key"]), "log_p": pa.array(value)})

    return over


def train(docs: DataFrame) -> DataFrame:
    """key and log_p (log10 of its last byte in its context) of every string
    that occurs in any document, learned from those not held out."""
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    # Dealt by string before they are added up: workers have folded them, so an aggregate ahead of the exchange finds no copies.
    counted = staged(rows.mapInArrow(_count_strings, "key long, n long").repartition("key").groupBy("key").agg(F.sum("n").alias("n")), "strings")
    by_root = (counted.withColumn("root", F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF)))
               .repartition("root").sortWithinPartitions("root"))
    tops = by_root.mapInArrow(_tops, "byte long, node long, n0 long, n1 long, log_p double").groupBy("byte", "node").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("log_p").alias("log_p"))
    # At most 256 x 255 rows, whatever the corpus.
    return by_root.mapInArrow(_log_probabilities(solve_top(tops.toPandas())), "key long, log_p double")


# --- scoring ---------------------------------------------------------------

class Lookup:
    """Values of sorted-out numbers by hash bucket."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        self.shift = np.uint64(64 - max(1, int(len(keys)).bit_length() + 1))
        bucket = mix64(keys) >> self.shift
        order = np.argsort(bucket, kind="stable")
        self.keys, self.values = keys[order], [v[order] for v in values]
        size = 1 << (64 - int(self.shift))
        self.first = np.searchsorted(bucket[order], np.arange(size, dtype=np.uint64)).astype(np.int32)

    def __call__(self, keys: np.ndarray) -> list[np.ndarray]:
        """Every key asked for is there."""
        at = self.first[mix64(keys) >> self.shift]
        wrong = np.flatnonzero(self.keys[at] != keys)
        while len(wrong):
            at[wrong] += 1
            wrong = wrong[self.keys[at[wrong]] != keys[wrong]]
        return [v[at] for v in self.values]


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the values between offsets; each document by itself, so that
    one does not change another's last digits."""
    if not len(values):
        return np.zeros(len(offsets) - 1)
    sums = np.add.reduceat(np.r_[values, 0.0], offsets[:-1])
    return np.where(np.diff(offsets) > 0, sums, 0.0)


def _score(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's documents with the answers for its strings and words."""
    word = right["word"].to_numpy()
    key, value = right["key"].to_numpy().view(np.uint64), right["value"].to_numpy()
    grams, terms = Lookup(key[~word], value[~word]), Lookup(key[word], value[word], right["known"].to_numpy()[word].astype(float))
    n_bytes, n_words, n_known, base, score = [], [], [], [], []
    for batch in left.to_batches():
        for _, _, data, offsets in _groups(batch["text"]):
            keys, at = strings(data, offsets)
            n_bytes.append(np.diff(at) - 1)
            score.append(_sums(grams(keys)[0], at))
            keys, at = words(data, offsets)
            n_words.append(np.diff(at))
            found = terms(keys) if len(keys) else [np.zeros(0), np.zeros(0)]
            base.append(_sums(found[0], at))
            n_known.append(_sums(found[1], at).astype(np.int64))
    return pa.table({"doc_id": left["doc_id"], "held_out": left["held_out"], "n_bytes": pa.array(np.concatenate(n_bytes)),
                     "n_words": pa.array(np.concatenate(n_words).astype(np.int64)), "known_words": pa.array(np.concatenate(n_known)),
                     "base": pa.array(np.concatenate(base)), "score": pa.array(np.concatenate(score))})


def score(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and
    bits_per_byte (the code length, its end symbol included, over the bytes of
    the text, of an empty one over one) of every document."""
    model = train(docs)
    sizes = docs.agg(F.sum(F.octet_length("text")).alias("b"),
                     F.count_if(~held_out(F.col("doc_id"))).alias("n")).first()
    n_blocks, train_docs = 1 + int((sizes.b or 0) // block_bytes), sizes.n
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        F.pmod(F.xxhash64("doc_id", F.crc32(text.cast("binary"))), F.lit(n_blocks)).cast("int").alias("block"),
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    base = base.repartition("block")
    asked = base.sortWithinPartitions("block").mapInArrow(_ask, "word boolean, key long, block int, n long")
    # A key's rows are one a block.
    same = W.partitionBy("word", "key")
    asked = asked.select("word", "key", "block", "n", F.sum("n").over(same).alias("c"),
                         (F.min("block").over(same) == F.col("block")).alias("first"))
    known = F.col("word") & (F.col("c") > 0)
    totals = asked.agg(F.coalesce(F.sum(F.when(F.col("word"), F.col("n"))), F.lit(0)).alias("words"),
                       F.count_if(known & F.col("first")).alias("distinct"))
    answers = asked.join(model.select(F.lit(False).alias("word"), "key", "log_p").hint("merge"), ["word", "key"], "left").select(
        "block", "word", "key", F.when(F.col("word"), F.log10(F.col("c") + 0.5)).otherwise(F.col("log_p")).alias("value"),
        known.alias("known"))
    found = base.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score, "doc_id long, held_out boolean, n_bytes long, n_words long, known_words long, base double, score double")
    total = totals.select(F.struct("words", "distinct")).scalar()
    n = total["words"] + F.lit(train_docs)
    v = total["distinct"] + F.lit(int(train_docs > 0))
    n_tokens = F.col("n_words") + 1
    return found.select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"), (F.col("known_words") + F.lit(int(train_docs > 0))).alias("n_known"),
        n.alias("train_tokens"),
        (F.col("base") + F.log10(F.lit(train_docs + 0.5)) - n_tokens * F.log10(n + 0.5 * (v + 1))).alias("base_score"), "score",
        (-F.col("score") / math.log10(2) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))
