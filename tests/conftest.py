import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ridgeline.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="ridgeline-tests-")
    s = get_session("local[4]", shuffle_partitions=4,
                    extra={"spark.local.dir": scratch, "spark.driver.memory": "4g",
                           "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="ridgeline-out-")
