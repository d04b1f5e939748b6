import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestat.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "tests", 8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g", "spark.driver.host": "localhost"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    def make(*values):
        return spark.createDataFrame([(v,) for v in values], "value string")

    return make


@pytest.fixture
def text_file(tmp_path):
    def write(name, *values):
        path = tmp_path / name
        path.write_text("\n".join(values) + "\n", encoding="utf-8")
        return str(path)

    return write
