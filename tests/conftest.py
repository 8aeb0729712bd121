import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import build_session

    scratch = tempfile.mkdtemp(prefix="tillroll-test-")
    s = build_session(
        "local[4]", app="tillroll-tests", shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
               "spark.driver.memory": "4g"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()
