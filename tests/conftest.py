import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from temblor.session import get_session
    warehouse = tempfile.mkdtemp(prefix="temblor-wh-")
    s = get_session("local[4]", app="temblor-tests", shuffle_partitions=4,
                    extra={"spark.sql.warehouse.dir": warehouse,
                           "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="temblor-test-")
