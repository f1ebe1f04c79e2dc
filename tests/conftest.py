import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricelens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="pricelens-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.local.dir": tempfile.mkdtemp(prefix="pricelens-test-local-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="pricelens-test-")
