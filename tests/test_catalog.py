"""Every registered query against its check SQL on the smallest data."""

import pytest

from streetgrain import catalog
from streetgrain.catalog.check import compare, connect

DATA = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
CHECKS = catalog.check_sql()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    if name in CHECKS:
        assert compare(spark, con, name, QUERIES[name], CHECKS[name], DATA) is None
    else:
        assert QUERIES[name](spark, DATA).count() > 0


def test_survey_keys_are_covered():
    """Each operator family of the survey has its queries."""
    counts = {"S": 18, "C": 32, "G": 14, "P": 11, "J": 15, "A": 19, "W": 6, "L": 8, "U": 6, "F": 15, "T": 8, "E": 10}
    for family, count in counts.items():
        for number in range(1, count + 1):
            key = f"{family}{number:02d}_"
            assert any(name.startswith(key) for name in QUERIES), key


def test_flagship_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["source_base", "count", "lon", "lat", "area"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
