import pytest

from alertloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate columns on a single row given as name=(value, type) pairs."""

    def run(columns, **fields):
        names = ", ".join(f"{n} {kind}" for n, (_, kind) in fields.items()) or "x INT"
        values = tuple(v for v, _ in fields.values()) or (1,)
        row = spark.createDataFrame([values], names).select(*columns).first()
        return row[0] if len(row) == 1 else tuple(row)

    return run
