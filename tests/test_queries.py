"""Every named query beside its SQL on the smallest data."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
import check_sql  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return check_sql.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    result = check_sql.compare(name, con, spark, FOLDER)
    assert not result.startswith("FAIL"), result


def test_entry(spark):
    assert entry.entry(spark).count() == 2


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
