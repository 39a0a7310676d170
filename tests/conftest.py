import os

import pytest

os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from tidegauge.session import get_session

    s = get_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": "/tmp/tidegauge-test-warehouse"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
