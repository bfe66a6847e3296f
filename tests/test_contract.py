"""Registered queries and their oracles agree on names and types; the flagship runs."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check import compare, duck

SF_DIR = "/root/testdata/sf0.001"
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


OWN = {
    **contract.PLANS,
    **contract.DEFECT_PLANS,
    **contract.INCOMPLETE_PLANS,
    **contract.ANONYMOUS_PLANS,
}


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(contract.oracle_sql())


def test_schemas_agree(spark, connection):
    different = {}
    for name in OWN:
        query = contract.queries()[name]
        expected = {column: TYPES.get(kind, kind) for column, kind in query(spark, SF_DIR).dtypes}
        sql = contract.oracle_sql()[name]
        connection.execute(f"CREATE OR REPLACE TEMP VIEW described AS {sql}")
        described = connection.execute("DESCRIBE described").fetchall()
        found = {row[0]: row[1] for row in described}
        if found != expected:
            different[name] = (expected, found)
    assert different == {}


@pytest.mark.parametrize("name", ["cleaned_order_items", "rfm_customers", "dq_policy", "cohort_matrix"])
def test_values_agree(spark, connection, name):
    assert compare(spark, connection, name, SF_DIR).startswith("ok")


def test_flagship(spark):
    found = contract.entry(spark)
    assert found.columns == ["segment", "customers", "revenue"]
    assert found.count() == 6
