import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from kestrel.session import local_session_for_tests  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session_for_tests(cores="*", shuffle_partitions=8)
    yield s


@pytest.fixture
def lines(spark):
    """Make a one-column ``value`` DataFrame from Python strings."""
    def make(rows, partitions=2):
        return spark.createDataFrame([(r,) for r in rows], "value string").repartition(partitions)
    return make


def rows(df, *cols):
    """Sorted tuples of a DataFrame's rows (optionally some columns)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
