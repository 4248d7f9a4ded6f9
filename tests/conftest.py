import pytest

from tidemill.runtime import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "4",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted tuples of a DataFrame."""
    return lambda df: sorted(tuple(r) for r in df.collect())


@pytest.fixture
def text_lines(spark):
    """A ``doc_id, line_no, line`` frame, one document per line."""
    return lambda *texts: spark.createDataFrame(
        [(i, 0, s) for i, s in enumerate(texts)], "doc_id bigint, line_no int, line string"
    )
