import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from loanweave.session import build_session
    ckpt = tempfile.mkdtemp(prefix="loanweave-test-")
    s = build_session("local[4]", app_name="loanweave-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.driver.memory": "4g"})
    yield s
    s.stop()
