import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from retailyze.session import get_spark
    wh = tempfile.mkdtemp(prefix="retailyze-wh-")
    s = get_spark("local[4]", app="retailyze-tests", shuffle_partitions=8,
                  extra={"spark.sql.warehouse.dir": wh, "spark.driver.memory": "6g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="retailyze-test-")
