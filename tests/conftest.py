import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wayfare.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
