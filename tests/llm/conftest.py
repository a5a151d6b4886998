import pytest

from termweave.llm.shared import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(session):
    """Python workers find the package wherever the tests are started."""
    ship(session)


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a table of documents, with extra columns whose names operators use themselves."""

    def build(rows):
        kind = "doc_id long, text string, id string, n int, row string, key string, hash string, _id int"
        return spark.createDataFrame([(i, t, "x", 7, "r", "k", "h", 1) for i, t in rows], kind)

    return build
