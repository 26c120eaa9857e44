"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES = {n: q for n, q in entry.queries().items() if n not in entry.LLM_QUERIES}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result, _, rows = check.compare(spark, duck, FOLDER, name, QUERIES[name], SQL[name])
    assert result == "ok" and rows > 0


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["source", "n", "west", "south", "east", "north", "year"]
    assert df.count() == 25
