"""The queries that SQL can express, against their DuckDB texts."""

import pytest

from auditloom.llm.queries import ORACLE, QUERIES
from checks.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
UNCHECKED = {   # tested against brute force, round trips and held-out labels instead
    "op1_token_output", "op2_simhash", "op4_secrets", "op5_packing", "op6_toxicity", "op7_warc", "op9_pii", "pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) is None


def test_entry_points():
    import __spark_entry__ as driver
    assert set(QUERIES) <= set(driver.queries())
    assert set(QUERIES) - set(driver.oracle_sql()) == UNCHECKED
