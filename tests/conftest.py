import pytest

from salesflow.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def broadcast_below(spark):
    """Sets the broadcast limit for one test."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)

    def limit(size: int) -> None:
        spark.conf.set(key, str(size))

    yield limit
    spark.conf.set(key, before)
