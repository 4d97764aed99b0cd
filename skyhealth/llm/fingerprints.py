"""SimHash fingerprints over 3-word shingles, vectorised per Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from xxhash import xxh64_intdigest

from skyhealth.llm.common import ASCII_LOWER, blobs, groups_of_docs, schema_of, small

SEED = 42
SHINGLE_WORDS = 3
#: Text whose shingle bits are held at a time.
GROUP_BYTES = 1 << 20


def shingles(text: bytes, size: int = SHINGLE_WORDS) -> list[bytes]:
    """The space-joined runs of ``size`` words, repeats included; a shorter
    text is one shingle, a text without words has none."""
    words = text.translate(ASCII_LOWER).split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def fingerprints(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """One unsigned 64-bit fingerprint per document: a bit is 1 if it is set in
    over half of the shingles' hashes."""
    out = np.zeros(len(offsets) - 1, np.uint64)
    raw = data.tobytes()
    for first, end in groups_of_docs(offsets, GROUP_BYTES):
        hashes, counts = [], np.zeros(end - first, np.int64)
        for d in range(first, end):
            found = shingles(raw[offsets[d]:offsets[d + 1]], size)
            counts[d - first] = len(found)
            hashes += [xxh64_intdigest(s, SEED) for s in found]
        if not hashes:
            continue
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        some = np.flatnonzero(counts)
        starts = np.r_[0, np.cumsum(counts[some])[:-1]]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        major = (2 * ones > counts[some][:, None]).astype(np.uint8)
        out[first + some] = np.packbits(major, axis=1).view(">u8").ravel()
    return out


def fingerprinted(docs: DataFrame, keep: list[str], size: int = SHINGLE_WORDS) -> DataFrame:
    """The ``keep`` columns and ``fp long`` (the fingerprint's bits as a signed
    number)."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            fp = fingerprints(*blobs(batch["text"]), size)
            yield pa.RecordBatch.from_pydict({c: batch[c] for c in keep} | {"fp": pa.array(fp.view(np.int64))})

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(over, schema_of(docs, keep, "fp long"))
