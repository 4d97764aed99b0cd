import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators use themselves.
    T.StructField("row", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("hits", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        """Documents from (doc_id, text) or (doc_id, text, lang)."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), "x", 0.5, 7) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def sample_docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


#: Nulls, empty and very long texts, ties and repeated rows.
ODD = [(None, "lost words of nobody"), (None, None), (1, None), (2, ""), (3, "   \n\t"), (4, "one"), (4, "one"), (4, "two other words here"),
       (5, "a" * 300), (6, "naïve café " * 60), (7, "x" * 99), (8, "The end.\n" * 40_000), (9, "123 456"), (9, "123 456"), (11, "½ ² Ⅷ"),
       (10, "long " * 30 + "\U0001f642 tail")]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD)


@pytest.fixture(scope="session")
def no_docs(docs_of):
    return docs_of([])
