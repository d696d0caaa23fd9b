import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from islet.session import get_session
    s = get_session("local[4]", shuffle_partitions=8,
                    extra={"spark.driver.memory": "4g",
                           "spark.sql.execution.arrow.pyspark.enabled": "true"})
    yield s
    s.stop()
