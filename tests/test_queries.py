"""Every registered query against its checking SQL on the smallest tables."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent / "tools"))

import check  # noqa: E402

from gleanery import checks  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
checks.load()


@pytest.fixture(scope="module")
def database():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", list(checks.QUERIES))
def test_query(spark, database, name):
    assert check.compare(spark, database, FOLDER, name) == ""


def test_every_query_has_checking_sql():
    assert set(checks.ORACLES) == set(checks.QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "repository"
