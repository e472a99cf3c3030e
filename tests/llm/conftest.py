import pytest

from txlab.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    ship(spark)


@pytest.fixture(scope="session")
def table(spark):
    """A small documents table, with columns whose names operators might use themselves."""

    def make(rows, schema="doc_id long, text string"):
        extra = ", _text string, words int, kept string, score int, host string, lang string, source string, n_rows int"
        filled = [(*row, "x", 1, "y", 2, "h", "en", "s", 3) for row in rows]
        return spark.createDataFrame(filled, schema + extra)

    return make
