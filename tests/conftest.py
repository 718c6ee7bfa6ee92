import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tierline.session import build_session

    ckpt = tempfile.mkdtemp(prefix="tierline-test-ckpt-")
    s = build_session("local[4]", app_name="tierline-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def folder(spark):
    from tierline.session import fresh_folder

    return lambda name="t": fresh_folder(spark, "tests", name)
