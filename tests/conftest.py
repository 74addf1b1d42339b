import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfsight.session import build_session


@pytest.fixture(scope="session")
def spark():
    # Without partition merging small tables keep several slices, so the range
    # paths are tested on real slice borders.
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def merged(spark):
    """Let adaptive execution merge partitions, as in production."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "true")
    yield spark
    spark.conf.set(key, "false")
