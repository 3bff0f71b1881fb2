import json

import pytest

from noticehouse.feeds.recall_notice import RECALL_NOTICE
from noticehouse.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": 4,
            "spark.default.parallelism": 4,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def spec():
    return RECALL_NOTICE


@pytest.fixture
def messages(spark):
    """Message DataFrame from dicts (as JSON), text and nulls; one column more
    per keyword."""

    def build(*payloads, **columns):
        texts = [json.dumps(p) if isinstance(p, dict) else p for p in payloads]
        rows = list(zip(texts, *columns.values()))
        types = ", ".join(["value string", *(f"{c} int" for c in columns)])
        return spark.createDataFrame(rows, types)

    return build
