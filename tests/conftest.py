import pytest

from nearspark.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = get_session(
        "nearspark-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(base / "checkpoints"),
        spark__sql__warehouse__dir=str(base / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def vectors(spark):
    """Four short vectors; the last one has no metadata."""
    rows = [
        (1, "Hello world", [0.1, 0.2, 0.3], '{"source":"test","category":"greeting"}'),
        (2, "Foo bar", [0.4, 0.5, 0.6], '{"source":"test","category":"misc"}'),
        (3, "Vector search", [0.7, 0.8, 0.9], '{"source":"demo","category":"tech"}'),
        (4, "No metadata doc", [0.15, 0.25, 0.35], "null"),
    ]
    return spark.createDataFrame(
        rows, "id long, content string, embedding array<float>, metadata string"
    ).cache()


@pytest.fixture(scope="session")
def users(spark):
    rows = [(1, "alice", 30), (2, "bob", None), (3, "carol", 41)]
    return spark.createDataFrame(rows, "id long, name string, age int").cache()
