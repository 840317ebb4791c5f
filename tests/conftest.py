import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from stellate.session import get_session

    scratch = tmp_path_factory.mktemp("spark")
    spark = get_session(
        "local[4]",
        app_name="stellate-tests",
        shuffle_partitions=8,
        extra={
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    yield spark
    spark.stop()


@pytest.fixture()
def out_dir(tmp_path):
    return str(tmp_path)
