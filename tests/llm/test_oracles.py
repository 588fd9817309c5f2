"""Registered queries against their DuckDB SQL on the small tables."""

import pytest

from tools.oracle_check import compare, duck
from vaultline.llm.queries import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    rec = compare(spark, SF, [name], duck(SF))[name]
    assert rec.get("status") == "OK", rec
