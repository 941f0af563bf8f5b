import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sigloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("sigloom-tests", cores="8", shuffle_partitions=2)
    # tiny inputs: interpreting an expression is faster than compiling it
    s.conf.set("spark.sql.codegen.wholeStage", "false")
    s.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sigloom-test-ckpt-"))
    return s


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def views(spark, sf):
    from sigloom.bindings.views import Views

    return Views(spark, sf)
