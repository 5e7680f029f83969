import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from skytrace.session import local_session

    # A non-UTC session time zone: every result must be independent of it.
    s = local_session(4, shuffle_partitions=4, tz="America/New_York", app="skytrace-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="skytrace-test-")


def docs_df(spark, items):
    """[(path, source_date, content)] → docs DataFrame."""
    return spark.createDataFrame(items, "path STRING, source_date STRING, content STRING")
