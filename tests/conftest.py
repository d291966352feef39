import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from telmart.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    opened = session(
        "local[8]", 8,
        **{
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    opened.sparkContext.setLogLevel("ERROR")
    yield opened
    opened.stop()
