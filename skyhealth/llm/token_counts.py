"""Token counts of flat token files.

A flat token file is one unbroken stream of fixed-width ids, documents divided
by an end-of-document id, no index. It is read by byte ranges, so a file may
have any size, in blocks that ignore document borders. Each block searches its
ids for the separator with one vectorised comparison and reports the tokens
before its first separator (head), after its last (tail) and between (whole
documents). A prefix scan over the blocks of a file, within parts of ``PART``
blocks and over the parts, numbers the documents; head and tail pieces of a
document that crosses blocks meet in an aggregate on (file, document number).

``write_files`` makes such files of documents: one per scan partition, under a
name of its own for each attempt, so a task that runs twice leaves a file that
no row of the list names.

Edge cases: an empty document counts zero tokens; a file that does not end in a
separator has a last, open document unless nothing follows the last separator;
an empty file or a null block holds no tokens; an empty table gives no files and
no rows; a block whose bytes are no whole number of ids is an error. Documents
of null text are empty; those of null doc_id, repeated rows and rows that share
a doc_id are documents of their own; a very long text runs on over blocks and
ranges; columns of ``docs`` beside doc_id and text are not read.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyhealth.llm import bpe
from skyhealth.llm.common import schema_of, small, staged
from skyhealth.session import scratch_path

#: The rank file's ids end at 50255, so this one is free and fits 16 bits.
END_OF_DOCUMENT = 50256
DTYPE = "<u2"
BLOCK_TOKENS = 1 << 18
#: Blocks that a task reads in a row, and whose summaries it scans.
PART = 128


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that executors share, and the path in it."""
    if uri.startswith(("/", "file:")):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(uri, safe=":/@"))


def read_files(spark: SparkSession, path: str, dtype: str = DTYPE, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of the flat files under ``path``. Spark lists the files; their
    contents are read by ranges through Arrow's file systems."""
    return read_ranges(spark.read.format("binaryFile").load(path).select("path", "length"), dtype, block_tokens)


def read_ranges(files: DataFrame, dtype: str = DTYPE, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """file_id, block_no and tokens of the listed files (path, length)."""
    size = np.dtype(dtype).itemsize * block_tokens
    asked = files.select("path", "length", F.explode(
        F.expr(f"sequence(0L, greatest(0L, (length - 1) div {size}), 1L)")).alias("block_no"))
    # Path and numbers only; the blocks of a part follow each other in one task.
    asked = asked.repartition("path", F.expr(f"block_no div {PART}")).sortWithinPartitions("path", "block_no")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["path"] != name:
                    if file:
                        file.close()
                    store, at = opened(r["path"])
                    name, file = r["path"], store.open_input_file(at)
                first = r["block_no"] * size
                file.seek(first)
                tokens = file.read(min(size, r["length"] - first))
                if len(tokens) != min(size, r["length"] - first):
                    raise OSError(f"{name} is shorter than listed")
                yield pa.RecordBatch.from_pydict({
                    "file_id": pa.array([r["file_id"]], pa.int64()), "block_no": pa.array([r["block_no"]], pa.int64()),
                    "tokens": pa.array([tokens], pa.binary())})
        if file:
            file.close()

    return asked.withColumn("file_id", F.xxhash64("path")).mapInArrow(over, "file_id long, block_no long, tokens binary")


def write_files(docs: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Writes the token stream of ``docs`` as flat files under the shared
    scratch folder. Returns the files (path, length) and, to name the counts,
    the documents in them (file_id, doc_no, doc_id); counting needs no such list."""
    path = path or bpe.default_path()
    folder = scratch_path(docs.sparkSession, f"tokens-{uuid.uuid4().hex}")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, name, file, doc_no = bpe.codec(path), None, None, 0

        def rows(doc_nos, doc_ids, lengths) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "path": pa.array([name] * len(doc_nos), pa.string()), "doc_no": pa.array(doc_nos, pa.int64()),
                "doc_id": pa.array(doc_ids, pa.int64()), "length": pa.array(lengths, pa.int64())})

        for batch in small(batches, bpe.WINDOW_BYTES):
            if file is None:
                name = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
                store, at = opened(name)
                store.create_dir(os.path.dirname(at), recursive=True)
                file = store.open_output_stream(at)
            ids, at = own.encode(batch["text"])
            file.write(np.insert(ids.astype(DTYPE), at[1:], END_OF_DOCUMENT).tobytes())
            n = batch.num_rows
            yield rows(range(doc_no, doc_no + n), batch["doc_id"].to_pylist(), [None] * n)
            doc_no += n
        if file is not None:
            length = file.tell()
            file.close()
            yield rows([None], [None], [length])

    made = staged(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        over, "path string, doc_no long, doc_id long, length long"), "token-files")
    return (made.where("length IS NOT NULL").select("path", "length"),
            made.where("length IS NULL").select(F.xxhash64("path").alias("file_id"), "doc_no", "doc_id"))


def scan_blocks(blocks: DataFrame, separator: int = END_OF_DOCUMENT, dtype: str = DTYPE) -> DataFrame:
    """Per block: ``n_sep`` separators and ``pieces``, the token counts between
    them (head first, tail last; a block without a separator is one piece).
    Own columns of these names are returned as ``<name>_input``."""
    blocks = bpe.apart(blocks, ["n_sep", "pieces"])
    cols = [c for c in blocks.columns if c != "tokens"]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_sep, pieces = [], []
            for raw in batch["tokens"]:
                ids = np.frombuffer(raw.as_buffer(), dtype) if raw.is_valid else np.zeros(0, dtype)
                at = np.flatnonzero(ids == separator)
                n_sep.append(len(at))
                pieces.append(np.diff(np.r_[-1, at, len(ids)]) - np.r_[np.ones(len(at), np.int64), 1])
            yield pa.RecordBatch.from_pydict({c: batch[c] for c in cols} | {
                "n_sep": pa.array(n_sep, pa.int64()), "pieces": pa.array(pieces, pa.list_(pa.int64()))})

    return blocks.select(*cols, "tokens").mapInArrow(over, schema_of(blocks, cols, "n_sep long, pieces array<long>"))


def count(blocks: DataFrame, separator: int = END_OF_DOCUMENT, dtype: str = DTYPE, named: DataFrame | None = None) -> DataFrame:
    """file_id, doc_no (its place in the file, from 0) and n_tokens; with the
    ``named`` documents of ``write_files`` also their doc_id."""
    found = scan_blocks(blocks.select("file_id", "block_no", "tokens"), separator, dtype)
    # Summaries and piece lengths, so that no file is read twice.
    found = staged(found.withColumn("part", F.expr(f"block_no div {PART}")), "summaries")
    in_part = W.partitionBy("file_id", "part").orderBy("block_no").rowsBetween(W.unboundedPreceding, -1)
    of_file = W.partitionBy("file_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = found.groupBy("file_id", "part").agg(F.sum("n_sep").alias("n")).select(
        "file_id", "part", F.coalesce(F.sum("n").over(of_file), F.lit(0)).alias("start"))
    pieces = found.join(parts, ["file_id", "part"]).select(
        "file_id", (F.col("start") + F.coalesce(F.sum("n_sep").over(in_part), F.lit(0))).alias("before"), "n_sep", "pieces")
    # Element k is the piece up to the block's separator k; the last has none.
    pieces = pieces.select("file_id", "before", "n_sep", F.posexplode("pieces").alias("k", "n")).select(
        "file_id", (F.col("before") + F.col("k")).alias("doc_no"), "n", (F.col("k") < F.col("n_sep")).alias("ended"),
        F.lit(None).cast("long").alias("doc_id"))
    if named is not None:
        pieces = pieces.unionByName(named.select(
            "file_id", "doc_no", F.lit(0).cast("long").alias("n"), F.lit(False).alias("ended"), "doc_id"))
    whole = pieces.groupBy("file_id", "doc_no").agg(
        F.sum("n").alias("n_tokens"), F.max("ended").alias("ended"), F.max("doc_id").alias("doc_id"))
    whole = whole.where(F.col("ended") | (F.col("n_tokens") > 0))
    return whole.select(*(["doc_id"] if named is not None else []), "file_id", "doc_no", "n_tokens")


def of_documents(docs: DataFrame, path: str | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Writes ``docs`` as flat token files and counts them there."""
    files, named = write_files(docs, path)
    return count(read_ranges(files, block_tokens=block_tokens), named=named)
