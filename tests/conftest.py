import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from riverbed.session import build_session
    ckpt = tempfile.mkdtemp(prefix="riverbed-test-ckpt-")
    s = build_session("local[4]", app="riverbed-tests", partitions=8,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="riverbed-test-warehouse-"),
                             "spark.sql.streaming.stateStore.providerClass":
                                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="riverbed-test-")
