"""Shared pieces of the training-data operators: scans, staging, Arrow views."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyhealth.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: bytes.translate table that lower-cases A-Z and leaves every other byte.
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staging_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` (or at ``path``)
    and read it back: cuts the lineage, and every executor can read it."""
    path = path or staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discarded(df: DataFrame, path: str | None) -> None:
    """Deletes a staged table that no later step reads."""
    if path:
        p = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def packed(df: DataFrame) -> DataFrame:
    """All columns as one struct ``row``, so that no name of theirs can clash
    with an operator's, beside ``text``."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col("text"))


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


def schema_of(df: DataFrame, keep: list[str], ddl: str) -> T.StructType:
    """The ``keep`` columns of ``df`` and those of ``ddl``."""
    return T.StructType([df.schema[c] for c in keep] + T.StructType.fromDDL(ddl).fields)


def blobs(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's UTF-8 bytes and its offsets; nulls are empty."""
    col = col.cast(pa.large_binary()).fill_null(b"") if col.null_count else col.cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def groups_of_docs(offsets: np.ndarray, most: int):
    """Consecutive documents of about ``most`` bytes together, as (first, end);
    a longer document stands alone."""
    n, first = len(offsets) - 1, 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, end
        first = end


def small(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of ``text``, so that what
    Python makes of the texts at a time stays small."""
    for batch in batches:
        _, offsets = blobs(batch["text"])
        for first, end in groups_of_docs(offsets, most):
            yield batch.slice(first, end - first)


def runs(keys: np.ndarray) -> np.ndarray:
    """Start indices of the runs of equal values in a sorted array."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), in place on a uint64 copy."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def by_key(batches: Iterator[pa.RecordBatch], key: str, names: list[str]) -> Iterator[dict]:
    """Columns of a stream sorted by ``key``, cut only between its values.
    Numeric columns come as arrays, others as Arrow columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch[key].to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(k, k[-1], "left"))
        if cut or (held and held[-1][key][0].as_py() != k[0]):
            parts = [*held, batch.slice(0, cut)]
            if sum(p.num_rows for p in parts):
                yield _columns(parts, names)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield _columns(held, names)


def by_key_in_parts(batches: Iterator[pa.RecordBatch], key: str, names: list[str], most: int) -> Iterator[tuple[dict, bool]]:
    """As ``by_key``, but a value with over ``most`` rows waiting comes in
    parts, alone and marked True, so that no more are ever held."""
    held: list[pa.RecordBatch] = []
    streamed = None
    for batch in batches:
        while batch.num_rows:
            k = batch[key].to_numpy(zero_copy_only=False)
            if streamed is not None:
                end = int(np.searchsorted(k, streamed, "right")) if k[0] == streamed else 0
                if end:
                    yield _columns([batch.slice(0, end)], names), True
                batch = batch.slice(end)
                if batch.num_rows:
                    streamed = None
                continue
            cut = int(np.searchsorted(k, k[-1], "left"))
            if cut or (held and held[-1][key][0].as_py() != k[0]):
                parts = [*held, batch.slice(0, cut)]
                yield _columns(parts, names), False
                held = []
            held.append(batch.slice(cut))
            if sum(p.num_rows for p in held) > most:
                yield _columns(held, names), True
                held, streamed = [], k[-1]
            break
    if held:
        yield _columns(held, names), False


def _columns(parts: list[pa.RecordBatch], names: list[str]) -> dict:
    table = pa.Table.from_batches(parts)
    return {c: table[c] if pa.types.is_binary(table.schema.field(c).type) else table[c].to_numpy() for c in names}
