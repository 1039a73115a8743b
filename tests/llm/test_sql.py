"""The queries of this subpackage against their SQL."""

import pytest
from oracle_check import connect, differences

from sitewright.llm.oracle import SQL
from sitewright.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    for sf_dir in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name]) == ""
