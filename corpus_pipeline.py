"""The corpus pipeline: five stages over ``documents``, each one operator.

Every stage gets what its predecessor kept, written as Parquet and read again.
All but the last return the columns of documents; the last returns token ids.
A stage's input is deleted once its output is written whole.

Edge cases: a null text, or one without a letter, has no language and goes in
the first stage; near copies, repeated rows included, become one row; a text cut
to nothing stays, as an empty one; very long texts are judged and encoded whole;
an empty table gives no rows; extra columns are carried up to the last stage,
whatever their names, which returns its own columns only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyhealth.llm import bpe, decontaminate, language, simhash, suffix_dedup
from skyhealth.llm.common import discarded, read_table, staged, staging_path


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language (``und``) go."""
    return language.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each component stays."""
    return simhash.keep_first(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: byte strings that occur earlier are cut out. A
    document cut to nothing stays, with an empty text."""
    return suffix_dedup.cleaned(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: contaminated documents go."""
    return decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: doc_id, n_tokens, the digests and the ids."""
    return bpe.digests(docs, ["doc_id"], with_ids=True)


STAGES = [
    ("language_id", identify),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeats),
    ("benchmark_decontamination", benchmark_free),
    ("byte_level_bpe", tokens),
]

#: Language models, fingerprints and merges are not SQL; tests compare each
#: stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = staging_path(spark, name)
        docs = staged(stage(spark, docs, sf_dir), name, path)
        discarded(docs, held)
        held = path
    return STAGES[-1][1](spark, docs, sf_dir)
