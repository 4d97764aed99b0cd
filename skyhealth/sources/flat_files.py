"""All-string flat files in a code page (S15) with typed rows and rejects.

Spark's CSV source takes the Unicode character sets and ISO-8859-1. The latter
gives every byte one character, so a file in any single-byte code page is read
through it, whole and in splits, and the upper 128 characters are then mapped
to those of the page, all inside the scan's projection.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BYTES = "ISO-8859-1"
RECORD = "_record"


def _upper(encoding: str) -> str:
    """The characters of bytes 128 to 255; one that the page lacks is U+FFFD."""
    page = bytes(range(128, 256)).decode(encoding, "replace")
    if len(page) != 128:
        raise ValueError(f"{encoding} is no single-byte code page")
    return page


_LATIN = bytes(range(128, 256)).decode(BYTES)


def decoded(text: Column, encoding: str) -> Column:
    """Text read through ISO-8859-1 as what its code page means."""
    return F.translate(text, _LATIN, _upper(encoding))


def encoded(text: Column, encoding: str) -> Column:
    """The reverse; a character that the page lacks becomes ``?``."""
    page = _upper(encoding)
    pairs = [(p, b) for p, b in zip(page, _LATIN) if p != "�"]
    known = "".join(p for p, _ in pairs)
    # Marked first, as the page's characters and Latin ones overlap.
    kept = F.regexp_replace(text, f"[^\\x00-\\x7F{known}]", "?")
    return F.translate(kept, known, "".join(b for _, b in pairs))


def read_flat_file(spark: SparkSession, path: str, types: Mapping[str, str], encoding: str = "windows-1256",
                   sep: str = ",") -> DataFrame:
    """One read of a header file of strings: the columns of ``types`` (by
    header name, in any order) cast to their type, and ``rejects``, an array of
    (column_name, raw_value) with the cells that are present but do not convert;
    a record with too few or too many fields rejects as a whole, as ``_record``.
    Columns that the file lacks are NULL."""
    # A quote inside quotes is doubled.
    reader = spark.read.option("header", True).option("sep", sep).option("escape", "\"").option("encoding", BYTES)
    columns = reader.csv(path).columns
    names = [f"_c{i}" for i in range(len(columns))]
    raw = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD).schema(
        ", ".join(f"{n} STRING" for n in [*names, RECORD])).csv(path)
    raw = raw.select(*[decoded(F.col(n), encoding).alias(n) for n in [*names, RECORD]])
    upper = str.maketrans(_LATIN, _upper(encoding))
    at = {c.translate(upper): n for c, n in zip(columns, names)}
    cell = {c: F.col(at[c]) if c in at else F.lit(None).cast("string") for c in types}
    typed = {c: cell[c].try_cast(t) for c, t in types.items()}
    bad = F.filter(F.array(*[F.struct(F.lit(c).alias("column_name"), cell[c].alias("raw_value"),
                                      (cell[c].isNotNull() & typed[c].isNull()).alias("bad")) for c in types]), lambda x: x["bad"])
    cells = F.transform(bad, lambda x: F.struct(x["column_name"].alias("column_name"), x["raw_value"].alias("raw_value")))
    whole = F.array(F.struct(F.lit(RECORD).alias("column_name"), F.col(RECORD).alias("raw_value")))
    return raw.select(*[typed[c].alias(c) for c in types], F.when(F.col(RECORD).isNotNull(), whole).otherwise(cells).alias("rejects"))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("rejects") == 0).drop("rejects")


def rejected(rows: DataFrame, row_id: str) -> DataFrame:
    """row_id, column_name and raw_value of every cell or record that failed."""
    return rows.select(row_id, F.inline("rejects"))


def write_lines(rows: DataFrame, lines: Column, header: str, path: str, encoding: str = "windows-1256") -> None:
    """Landed lines as they are, under a header, in a code page."""
    (rows.select(encoded(lines, encoding).alias(header)).write.option("header", True).option("encoding", BYTES)
     .option("sep", "\x01").option("quote", "").option("escapeQuotes", False).csv(path))
