import pytest

from ledgerlark.llm.registry import ready


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    """Python workers get the package whatever folder the tests start in."""
    return ready(spark)


@pytest.fixture
def table(spark):
    """Documents from (id, text, source) rows, with a column that clashes with inner names."""

    def make(*rows):
        data = [(i, text, source, "x", -1) for i, text, source in rows]
        return spark.createDataFrame(data, "doc_id bigint, text string, source string, t string, place int")

    return make
