"""The registered queries of the operators, on whole small tables, beside their SQL."""

import pytest

import __spark_entry__
from sensorgrid.llm.queries import ORACLES, QUERIES
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, QUERIES[name], ORACLES.get(name)) == ""


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n[:2] == "op" and n[2].isdigit()}
    assert set(__spark_entry__.oracle_sql()) <= set(names)
