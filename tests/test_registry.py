"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, duck, name):
    assert check.compare(spark, duck, name, SF_DIR).startswith(("ok", "rows only"))


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_names_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_approximate_visitors_are_close(spark):
    queries = entry.queries()
    exact = queries["uv_exact"](spark, SF_DIR).selectExpr("window_start", "visitors AS exact")
    near = queries["uv_approx"](spark, SF_DIR).join(exact, "window_start")
    assert near.where("abs(visitors - exact) > 0.1 * exact").count() == 0 and near.count() == exact.count()
