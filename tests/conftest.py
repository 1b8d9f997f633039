import os
import sys
from datetime import timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rivulet.operators.segments import Skew  # noqa: E402
from rivulet.session import ROCKSDB, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4, **{"spark__sql__streaming__stateStore__providerClass": ROCKSDB})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    """Limits so low that small inputs are cut along every level."""
    return Skew(hot_rows=6, segment_rows=4, levels=(timedelta(seconds=10), timedelta(seconds=1)))


@pytest.fixture
def rows(spark):
    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make


def ordered(data):
    """Tuples sorted by value, None first."""
    return sorted(data, key=lambda row: [(v is not None, v) for v in row])


def values(df, *columns):
    """Sorted tuples of the columns (all of them by default)."""
    picked = df.select(*columns) if columns else df
    return ordered(tuple(r) for r in picked.collect())
