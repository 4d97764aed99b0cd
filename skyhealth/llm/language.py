"""Language identification by cross-parsing entropy.

A bounded sample of labelled text per language becomes a suffix automaton. A
document is parsed, left to right, into the longest phrases that occur in a
language's sample; few phrases mean a close language. The count is normalised
by the bits a phrase costs (log2 of the sample's length), and the language with
the least wins, ties by name. Texts are cut in blocks of ``BLOCK`` symbols and
the blocks of a batch are parsed side by side, one symbol a step, so that the
walk over the automata is vectorised. A block that began inside a phrase is then
walked again from the state its predecessor ended in, until the two walks meet,
so the count of a text of any length is that of its one parse from left to right.

Only text and lang of the learning rows are used; a prediction sees the text
alone. Edge cases: null text or text without a letter is ``und`` with score 0;
rows with null lang are not learned from; without any learning row everything is
``und``; with one language its score is 1; repeated rows are predicted each; an
empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyhealth.llm.common import packed, schema_of, small, unpacked

#: Normalised bytes learned per language. The sample is broadcast (this much a
#: language) and each worker builds the automata.
LEARN_BYTES = 1 << 14
BLOCK = 1024
GROUP_BYTES = 4 << 20
FOLDS, HELD_OUT = 4, 2

_SPACES = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def normal(text: str) -> bytes:
    """Lower-case letters, words divided by one space."""
    return b" ".join(text.lower().encode().translate(_SPACES).split())


def automaton(text: bytes, codes: np.ndarray, width: int) -> np.ndarray:
    """Suffix automaton of ``text`` as a table: row s, column code, the next
    state. A step that starts a phrase carries FRESH: those from the root, and
    where a state has no next one, the root's step. Column 0 pads and stays."""
    table = np.full((2 * len(text) + 1, width), -1, np.int32)
    link, length, last = [-1], [0], 0
    for c in codes[np.frombuffer(text, np.uint8)].tolist():
        cur = len(link)
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and table[p, c] < 0:
            table[p, c] = cur
            p = link[p]
        if p >= 0:
            q = int(table[p, c])
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(link)
                table[clone] = table[q]
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and table[p, c] == q:
                    table[p, c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    table = table[:len(link)].copy()
    start = np.maximum(table[0], 0) + FRESH
    for first in range(0, len(table), 4096):
        part = table[first:first + 4096]
        np.copyto(part, start, where=part < 0)
    table[0] = start
    table[:, 0] = np.arange(len(link))
    return table


FRESH = 1 << 30


class Model:
    """The automata of all learned languages, by name."""

    def __init__(self, samples: tuple[tuple[str, bytes], ...]):
        self.names = [name for name, _ in samples]
        seen = sorted({b for _, text in samples for b in text})
        # 0 pads; 1 stands for symbols that no sample has.
        self.codes = np.ones(256, np.uint8)
        self.codes[seen] = np.arange(2, len(seen) + 2) if len(seen) < 254 else np.minimum(np.arange(2, len(seen) + 2), 255)
        self.width = int(self.codes.max()) + 1
        self.tables = [automaton(text, self.codes, self.width).ravel() for _, text in samples]
        self.bits = [math.log2(max(2, len(text))) for _, text in samples]

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrase counts, a row per text and a column per language."""
        out = np.zeros((len(texts), len(self.names)), np.int64)
        sizes = np.array([len(t) for t in texts])
        first = 0
        while first < len(texts):
            end = max(first + 1, int(np.searchsorted(np.cumsum(sizes[first:]), GROUP_BYTES, "right")) + first)
            self._group(texts[first:end], out[first:end])
            first = end
        return out

    def _group(self, texts: list[bytes], out: np.ndarray) -> None:
        blocks = [-(-len(t) // BLOCK) for t in texts]
        grid = np.zeros((sum(blocks), BLOCK), np.uint8)
        row = 0
        for t, n in zip(texts, blocks):
            if n:
                grid[row:row + n].reshape(-1)[:len(t)] = self.codes[np.frombuffer(t, np.uint8)]
                row += n
        owner = np.repeat(np.arange(len(texts)), blocks)
        # Full blocks first, so that the rest can drop out as they end.
        length = (grid != 0).sum(axis=1)
        order = np.argsort(-length, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        # The block of the same text before each one, -1 for a text's first.
        before = np.where((order > 0) & (owner[order] == owner[order - 1]), place[order - 1], -1)
        grid, owner, length = np.ascontiguousarray(grid[order].T), owner[order], length[order]
        alive = len(owner) - np.searchsorted(length[::-1], np.arange(BLOCK), "right")
        for k, table in enumerate(self.tables):
            state, count = np.zeros(len(owner), np.int32), np.zeros(len(owner), np.int64)
            for t in range(BLOCK):
                n = alive[t]
                if not n:
                    break
                step = table[state[:n] * np.int32(self.width) + grid[t, :n]]
                count[:n] += step >> 30
                state[:n] = step & (FRESH - 1)
            self._join(table, grid, length, before, state, count)
            np.add.at(out[:, k], owner, count)

    def _join(self, table: np.ndarray, grid: np.ndarray, length: np.ndarray, before: np.ndarray, end: np.ndarray,
              count: np.ndarray) -> None:
        """Corrects ``count`` and ``end`` of blocks walked from the root to those
        of a walk from their predecessors' ends. Where the old and the new walk
        come to one state, the rest of the block is the same."""
        entered, width = np.zeros_like(end), np.int32(self.width)
        while True:
            start = np.where(before >= 0, end[before], 0).astype(np.int32)
            rows = np.flatnonzero(start != entered)
            if not len(rows):
                return
            was, now = entered[rows], start[rows]
            entered[rows] = now
            t = 0
            while len(rows):
                symbol = grid[t, rows]
                was, now = table[was * width + symbol], table[now * width + symbol]
                count[rows] += (now >> 30) - (was >> 30)
                was, now = was & (FRESH - 1), now & (FRESH - 1)
                t += 1
                over = length[rows] == t
                end[rows[over]] = now[over]
                apart = (was != now) & ~over
                rows, was, now = rows[apart], was[apart], now[apart]


_held: dict[tuple, Model] = {}


def model(samples: tuple[tuple[str, bytes], ...]) -> Model:
    """The worker's one model; another sample's goes before it is built."""
    if samples not in _held:
        _held.clear()
        _held[samples] = Model(samples)
    return _held[samples]


def learn(docs: DataFrame, learn_bytes: int = LEARN_BYTES) -> tuple[tuple[str, bytes], ...]:
    """The sample per language: documents in hash order until ``learn_bytes``
    of normalised text. Rows are drawn by a hash of the text at a rate that
    gives each language about twice that, so little reaches the driver."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.where(F.col("text").rlike(r"\p{L}")).select("lang", "text")
    coin = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / float(1 << 40)
    start = F.substring("text", 1, learn_bytes)
    # A language of few, long texts may have none drawn; its first one serves.
    langs = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n"), F.min_by(start, coin).alias("first")).collect()
    sizes = {r.lang: r.n for r in langs}
    rate = F.lit(0.0)
    for lang, n in sizes.items():
        rate = F.when(F.col("lang") == lang, min(1.0, 3 * learn_bytes / max(n, 1))).otherwise(rate)
    drawn = (rows.where(coin < rate).groupBy("lang", "text").agg(F.min(coin).alias("coin"))
             .select("lang", "coin", start.alias("text")).orderBy("lang", "coin").toLocalIterator())
    samples: dict[str, bytes] = {}
    for r in drawn:
        have = samples.setdefault(r.lang, b"")
        if len(have) < learn_bytes:
            samples[r.lang] = (have + b" " + normal(r.text))[:learn_bytes]
    for r in langs:
        samples.setdefault(r.lang, normal(r.first)[:learn_bytes])
    return tuple((lang, samples[lang]) for lang in sorted(samples) if samples[lang].strip())


def predict(docs: DataFrame, samples: tuple[tuple[str, bytes], ...], keep: list[str]) -> DataFrame:
    """The ``keep`` columns, ``lang_pred`` and ``score``: how the runner-up's
    cost compares with the winner's, 0.5 for a tie, towards 1 the further off."""
    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(shared.value)
        bits = np.array(own.bits)
        for batch in small(batches):
            texts = [t or "" for t in batch["text"].to_pylist()]
            lettered = np.array([bool(_LETTER.search(t)) for t in texts], bool) & (len(own.names) > 0)
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            some = np.flatnonzero(lettered)
            if len(some):
                cost = own.phrases([normal(texts[i]) for i in some]) * bits
                best = cost.argmin(axis=1)
                least = cost.min(axis=1)
                if len(bits) > 1:
                    second = np.partition(cost, 1, axis=1)[:, 1]
                    # A text with no known symbol costs nothing anywhere.
                    scores[some] = np.where(second > 0, second / np.maximum(least + second, 1e-9), 0.5)
                else:
                    scores[some] = 1.0
                for i, b in zip(some, best):
                    names[i] = own.names[b]
            yield pa.RecordBatch.from_pydict({c: batch[c] for c in keep} | {
                "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores)})

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(
        over, schema_of(docs, keep, "lang_pred string, score double"))


def identify(docs: DataFrame, learn_bytes: int = LEARN_BYTES) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    found = predict(docs, learn(docs, learn_bytes), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, learn_bytes: int = LEARN_BYTES) -> DataFrame:
    """The documents with a language, columns unchanged; ``und`` goes."""
    found = predict(packed(docs), learn(docs, learn_bytes), ["row"])
    return unpacked(found.where(F.col("lang_pred") != "und"), docs.columns)
