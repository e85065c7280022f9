"""Every registered query against its SQL, at the smallest scale."""

import __spark_entry__ as contract
import pytest
from check import compare

SF = "/root/testdata/sf0.001"
# FIXTURES.md
EXPECTED_ROWS = {"clean_dropna": 1508, "clean_all": 1479, "star_fact": 1450}


# The training-data queries have tests of their own.
NAMES = [n for n in contract.queries() if not n.startswith("op") and n != "pipeline"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, name):
    ok, note = compare(spark, name, SF)
    assert ok, note
    if name in EXPECTED_ROWS:
        assert note.startswith(f"{EXPECTED_ROWS[name]} rows")


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 1450
