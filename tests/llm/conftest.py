import duckdb
import pytest

from marketlake.llm.queries import QUERIES
from tests.conftest import SF_DIR

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, digest string, _id long"


@pytest.fixture(scope="session")
def run(spark):
    """Rows of a query over the smallest tables, once for all tests."""
    made = {}

    def rows(name):
        if name not in made:
            made[name] = QUERIES[name](spark, SF_DIR).toPandas()
        return made[name]

    return rows


@pytest.fixture(scope="session")
def given():
    """The given documents in order of doc_id."""
    return duckdb.sql(f"SELECT * FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").df()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty texts, white space alone, repeated rows, ties, a long text, columns with clashing names."""
    long = " ".join(f"wort{i % 977} und noch eins" for i in range(20_000))
    rows = [
        (1, "the cat sat on the mat", "en", "a", 22),
        (2, "the cat  sat on\tthe mat", "en", "a", 23),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \n\t", "en", "b", 3),
        (6, "the cat sat on the mat", "en", "c", 22),
        (6, "the cat sat on the mat", "en", "c", 22),
        (None, "the cat sat on the mat", None, "c", 22),
        (7, long, "de", None, len(long)),
        (8, "12 34 !!", "en", "a", 8),
        (None, None, None, None, None),
        (9, "größe  straße ÄÖÜ 日本語 \U0001f600", "de", "b", 5),
    ]
    return spark.createDataFrame([(*r, "row", "digest", 5) for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
