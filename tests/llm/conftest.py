import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

LONG = "Among the hills a small river runs past the old mill, and every spring its water rises over the stones by the door. "
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, node long, place long, score double"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names the operators use themselves."""

    def make(rows):
        full = [(i, t, lang, source, None if t is None else len(t), "r", None, 1, 2, 0.5) for i, t, lang, source in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and white texts, repeated rows and ids, a very long text, ties."""
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "a"), (4, LONG * 20, "en", "a"), (5, LONG * 20, "en", "a"), (5, LONG * 20, "en", "a"),
        (6, LONG * 3 + "x", "en", "b"), (7, "One", "fr", None), (None, LONG * 20, "en", "b"), (None, None, None, "b"), (8, "$ 12 !!", "en", "b"),
        (9, "Zu und der Bergfluß " * 9000, "de", "b"), (10, "zu\x0bund der  Bergfluß", "de", "c"), (10, "another text with one id", "en", "c"), (11, "aa " * 500, "en", "c"),
    ]
    return make_docs(rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], StructType([StructField("doc_id", LongType()), *[StructField(c, StringType()) for c in ("text", "lang", "source")]]))


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest table of documents, as rows and as a DataFrame."""
    path = "/root/testdata/sf0.001/documents.parquet"
    try:
        df = spark.read.parquet(path)
    except Exception:  # the tables are optional
        pytest.skip("no test tables")
    return df.collect(), df
