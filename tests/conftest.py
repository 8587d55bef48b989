import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from streetflow.session import local_session

    s = local_session("4", shuffle_partitions=8, app="streetflow-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="streetflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_store(spark, tmp_path):
    from streetflow.plans.tables import TableStore

    st = TableStore(spark, str(tmp_path / "tables"))
    st.create_schema()
    return st
