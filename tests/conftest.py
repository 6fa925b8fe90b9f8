from __future__ import annotations

from collections.abc import Iterator

import pytest
from pyspark.sql import SparkSession

from lakeweir.session import build_session


@pytest.fixture(scope="session")
def spark() -> Iterator[SparkSession]:
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    }
    session = build_session("tests", conf, master="local[8]")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
