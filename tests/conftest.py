import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from tidemark.session import get_spark
    s = get_spark("local[*]", app="tidemark-tests", shuffle_partitions=8,
                  spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="tidemark-warehouse-"))
    yield s
    s.stop()


@pytest.fixture
def workdir(spark):
    from tidemark.session import shared_dir
    return shared_dir(spark, "tests")


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
