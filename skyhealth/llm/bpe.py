"""Byte-level BPE encoding and decoding.

Whole Arrow batches are cut between bytes where the split pattern always ends a
match, and the distinct strings found are split by the pattern. The `tokenizers`
library encodes the pieces, each being one match of the pattern. Its model works
on characters, so every byte is mapped to one printable character (the usual
byte-level table) and the rank file's byte strings are turned into a vocabulary
and merges over those characters. Decoding joins the ids' characters and takes
each back to its byte by the reversed table, so a character of the text that is
split over several tokens comes back whole. Offsets follow from the decoded
bytes: a token spans every character that it holds a byte of.

Edge cases: a null text is empty (no ids, and the digests of nothing); special
token strings in a text are ordinary text; repeated rows are encoded each;
unpaired or unusual characters are just their bytes; a very long text is cut in
windows and encoded by its distinct pieces; an empty table gives no rows;
an input column that has the name of a new one is returned as ``<name>_input``.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyhealth.llm.common import blobs, schema_of, small

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes of text taken at a time.
WINDOW_BYTES = 2 << 20
#: Strings a worker keeps with their ids before only the last window's stay,
#: and the longest that it keeps.
KNOWN_STRINGS = 100_000
KNOWN_CHARS = 32
#: Pieces in one call's string, and what separates them: no byte's character.
PIECES_A_CALL = 64
SEPARATOR = " "

# Classes of bytes. No match of the pattern goes on over these pairs of ASCII
# bytes, and none looks back; whitespace looks ahead, so nothing is cut after it.
SPACE, LETTER, DIGIT, QUOTE, SIGN, OTHER = range(6)
ENDS = {LETTER: (DIGIT, QUOTE, SIGN, SPACE), DIGIT: (LETTER, QUOTE, SIGN, SPACE), SIGN: (LETTER, DIGIT, SPACE),
        QUOTE: (DIGIT, SPACE)}


def byte_classes() -> np.ndarray:
    """The class of each byte; OTHER, of which nothing is assumed, holds the
    bytes beyond ASCII and 28 to 31, whitespace by some definitions."""
    of = np.full(256, OTHER, np.uint8)
    for b in (*range(28), *range(32, 128)):
        c = chr(b)
        of[b] = (SPACE if c in " \t\n\v\f\r" else LETTER if c.isalpha() else DIGIT if c.isdigit()
                 else QUOTE if c == "'" else SIGN)
    return of


CLASS_OF = byte_classes()
ENDS_AT = np.array([b in ENDS.get(a, ()) for a in range(6) for b in range(6)])
#: The last byte of every whitespace character beyond ASCII, all of which begin
#: with C2 (two bytes) or E1 to E3 (three bytes).
SPACE_TAIL = np.isin(np.arange(256), [*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])


def cuts(data: np.ndarray) -> np.ndarray:
    """For each byte, whether a match of the pattern surely ends before it."""
    of = CLASS_OF[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = ENDS_AT[of[:-1] * np.uint8(6) + of[1:]]
    # Whitespace after a character beyond ASCII that is none itself.
    at = np.flatnonzero((of[1:] == SPACE) & (data[:-1] >= 0x80))
    at = at[at >= 2]
    first = data[at - 2]
    cut[at[~(SPACE_TAIL[data[at]] & ((data[at - 1] == 0xC2) | ((first >= 0xE1) & (first <= 0xE3))))] + 1] = True
    return cut


def strings(data: np.ndarray, offsets: np.ndarray) -> Iterator[pa.Array]:
    """The texts in ``data`` cut into strings that can be split by the pattern
    one by one; a window's last one is left to the next."""
    held = 0
    for first in range(0, len(data), WINDOW_BYTES):
        end, back = min(first + WINDOW_BYTES, len(data)), max(first - 3, 0)
        cut = cuts(data[back:end])[first - back:]
        starts = offsets[np.searchsorted(offsets, first):np.searchsorted(offsets, end)]
        cut[starts - first] = True
        bounds = np.flatnonzero(cut) + first
        if end == len(data):
            bounds = np.append(bounds, end)
        if len(bounds) and bounds[-1] > held:
            bounds = bounds if bounds[0] == held else np.append(held, bounds)
            yield pa.LargeStringArray.from_buffers(
                len(bounds) - 1, pa.py_buffer(bounds - held), pa.py_buffer(data[held:bounds[-1]]))
            held = bounds[-1]


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else
    the next free one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in own else next(free)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def parts(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The pieces that the merges of lower rank leave of a token."""
    own, pieces = ranks[token], [bytes([b]) for b in token]
    while True:
        found = [(r, i) for i in range(len(pieces) - 1)
                 if (r := ranks.get(pieces[i] + pieces[i + 1], own)) < own]
        if not found:
            return pieces
        i = min(found)[1]
        pieces[i:i + 2] = [pieces[i] + pieces[i + 1]]


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        letter = byte_characters()
        chars = {t: "".join(letter[b] for b in t) for t in ranks}
        merges = []
        for token in sorted(ranks, key=ranks.get):
            if len(token) > 1:
                pair = parts(token, ranks)
                if len(pair) == 2:
                    merges.append((chars[pair[0]], chars[pair[1]]))
        self.tokenizer = Tokenizer(models.BPE({chars[t]: r for t, r in ranks.items()}, merges, cache_capacity=0))
        # Pieces come already split and mapped.
        self.tokenizer.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(SEPARATOR)
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        self.char_of = np.array([ord(c) for c in letter], np.uint16)
        #: Each id's characters, and how many; none for an id without a token.
        by_id = [""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            by_id[r] = chars[t]
        self.chars_of = pa.array([c.encode("utf-16-le") for c in by_id], pa.large_binary())
        self.size_of = np.array([len(c) for c in by_id], np.int32)
        #: The byte of each character of the table; the characters lie below 512.
        self.byte_of = np.zeros(512, np.uint8)
        self.byte_of[self.char_of] = np.arange(256)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin and end in them."""
        data, offsets = blobs(texts)
        found = [np.zeros(0, "<u4")]
        for cut in strings(data, offsets):
            coded = cut.dictionary_encode()
            own = pa.array(self.ids_of(coded.dictionary.to_pylist()), pa.large_binary())
            found.append(np.frombuffer(own.take(coded.indices).buffers()[2], "<u4"))
        ids = np.concatenate(found)
        return ids, self.bounds(ids, offsets)

    def bounds(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where in the ids the byte offsets lie, the last being their end."""
        ends = np.cumsum(self.size_of[ids], dtype=np.int64)
        if (ends[-1] if len(ends) else 0) != offsets[-1]:
            raise ValueError("the rank file does not cover every byte")
        return np.searchsorted(ends, offsets, "right")

    def ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of each distinct string, as little-endian 32-bit numbers.
        Each is split and encoded once while it stays known."""
        known = self.known
        new = [w for w in words if w not in known]
        # One optional space and letters are one piece.
        several = {w: self.pieces(w) for w in new if not w.removeprefix(" ").isalpha()}
        pieces = [w for w in new if w not in several]
        pieces += {p for own in several.values() for p in own if p not in known}.difference(pieces)
        known.update(zip(pieces, self.ids_of_pieces(pieces)))
        for w, own in several.items():
            if len(own) > 1:
                known[w] = b"".join(map(known.__getitem__, own))
        found = list(map(known.__getitem__, words))
        if len(known) > KNOWN_STRINGS:
            self.known = {w: ids for w, ids in zip(words, found) if len(w) <= KNOWN_CHARS}
        else:
            for w in {w for w in (*pieces, *several) if len(w) > KNOWN_CHARS}:
                del known[w]
        return found

    def ids_of_pieces(self, pieces: list[str]) -> list[bytes]:
        """The library's ids of each piece, many pieces a call."""
        if not pieces:
            return []
        coded = list(map(str.encode, pieces))
        ends = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)))
        # A separator follows each piece; the calls take whole pieces.
        chars = np.insert(self.char_of[np.frombuffer(b"".join(coded), np.uint8)], ends, ord(SEPARATOR))
        text = chars.tobytes().decode("utf-16-le")
        to = [*(ends + np.arange(1, len(ends) + 1))[PIECES_A_CALL - 1:-1:PIECES_A_CALL].tolist(), len(text)]
        calls = [text[a:b] for a, b in zip([0, *to], to)]
        ids = np.fromiter(itertools.chain.from_iterable(
            e.ids for e in self.tokenizer.encode_batch_fast(calls, add_special_tokens=False)), "<u4")
        at = (4 * self.bounds(ids, np.append(0, ends))).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in itertools.pairwise(at)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, by the reversed byte table."""
        if not len(ids):
            return np.zeros(0, np.uint8)
        chars = self.chars_of.take(pa.array(ids)).buffers()[2]
        if not self.size_of[ids].all():
            raise KeyError("an id without a token")
        return self.byte_of[np.frombuffer(chars, np.uint16)]

    def offsets(self, ids: np.ndarray, at: np.ndarray, decoded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each token's first and end character in its text, the texts' ids
        lying between the bounds ``at``; a token that holds part of a character
        spans all of it."""
        begun = np.cumsum((decoded & 0xC0) != 0x80, dtype=np.int32)
        last = np.cumsum(self.size_of[ids], dtype=np.int64)
        last -= 1
        ends = begun[last]
        last -= self.size_of[ids] - 1
        starts = begun[last] - 1
        held = np.diff(at)
        before = np.repeat(starts[at[:-1][held > 0]], held[held > 0])
        starts -= before
        ends -= before
        return starts, ends


@functools.cache
def codec(path: str) -> Codec:
    """One codec per Python worker."""
    return Codec(path)


def default_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def apart(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with its own columns of these names as ``<name>_input``."""
    return df.withColumnsRenamed({c: f"{c}_input" for c in names if c in df.columns})


def lists(at: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.astype(np.int32, copy=False)))


def encode(docs: DataFrame, path: str | None = None, offsets: bool = False) -> DataFrame:
    """``docs`` with ``ids array<int>`` and, if asked, ``starts`` and ``ends``
    (each token's character offsets in its text)."""
    path = path or default_path()
    more = ["ids", "starts", "ends"] if offsets else ["ids"]
    docs = apart(docs, more)
    cols = docs.columns

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in small(batches, WINDOW_BYTES):
            ids, at = own.encode(batch["text"])
            found = [ids, *own.offsets(ids, at, own.decode(ids))] if offsets else [ids]
            yield pa.RecordBatch.from_pydict({c: batch[c] for c in cols} | {c: lists(at, v) for c, v in zip(more, found)})

    return docs.mapInArrow(over, schema_of(docs, cols, ", ".join(f"{c} array<int>" for c in more)))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded binary``: the bytes of its ``ids``."""
    path = path or default_path()
    encoded = apart(encoded, ["decoded"])
    cols = encoded.columns

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            ids = batch["ids"].flatten().to_numpy(zero_copy_only=False)
            text, size = own.decode(ids).tobytes(), np.append(0, np.cumsum(own.size_of[ids], dtype=np.int64))
            at = np.append(0, np.cumsum(batch["ids"].value_lengths().fill_null(0).to_numpy()))
            back = [text[a:b] for a, b in itertools.pairwise(size[at].tolist())]
            yield pa.RecordBatch.from_pydict({c: batch[c] for c in cols} | {"decoded": pa.array(back, pa.binary())})

    return encoded.mapInArrow(over, schema_of(encoded, cols, "decoded binary"))


def sha256_of(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """The digests of the rows of ``values`` between the bounds ``at``."""
    return pa.array([hashlib.sha256(values[a:b]).hexdigest() for a, b in itertools.pairwise(at.tolist())], pa.string())


def digests(docs: DataFrame, keep: list[str], with_ids: bool = False, path: str | None = None) -> DataFrame:
    """Encode and decode in one pass over the batches: the ``keep`` columns,
    the token count, the digests of ids, of the decoded bytes and of the offsets
    (each token's first and end character, as little-endian 32-bit pairs), and
    the ids themselves if asked."""
    path = path or default_path()

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in small(batches, WINDOW_BYTES):
            ids, at = own.encode(batch["text"])
            decoded = own.decode(ids)
            spans = np.stack(own.offsets(ids, at, decoded), axis=1).astype("<i4", copy=False)
            size = np.append(0, np.cumsum(own.size_of[ids], dtype=np.int64))
            yield pa.RecordBatch.from_pydict(
                {c: batch[c] for c in keep}
                | {"n_tokens": pa.array(np.diff(at), pa.int64()), "ids_sha256": sha256_of(ids, at),
                   "decoded_sha256": sha256_of(decoded, size[at]), "offsets_sha256": sha256_of(spans, at)}
                | ({"ids": lists(at, ids)} if with_ids else {}))

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(over, schema_of(
        docs, keep, "n_tokens long, ids_sha256 string, decoded_sha256 string, offsets_sha256 string"
        + (", ids array<int>" if with_ids else "")))


def round_trips(encoded: DataFrame) -> DataFrame:
    """Adds ``same``: whether decoding gave the text's own bytes."""
    return encoded.withColumn("same", F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary"))
