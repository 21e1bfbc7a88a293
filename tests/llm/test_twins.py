"""Every query of the subpackage that has a DuckDB twin, against it."""

import pytest
from compare import connect, differences

from tripmill.llm import oracle, queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle.sql()))
def test_equals_sql(spark, name):
    assert differences(queries.queries()[name](spark, SF_DIR), connect(SF_DIR), oracle.sql()[name]) == []
