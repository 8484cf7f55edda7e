"""Every registered query with SQL against DuckDB, the way the driver compares them."""

import pytest
from oracle_check import canon

from aislekit.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(name, spark, sf_dir, duck):
    df = queries.QUERIES[name](spark, sf_dir)
    cur = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    sc, sv = canon(df.columns, df.collect())
    dc, dv = canon(names, cur.fetchall())
    assert sc == dc
    assert sv == dv
