"""Every corpus query that SQL can express equals its DuckDB SQL."""

from collections import Counter

import duckdb
import pytest

from postlake.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, sf_small, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = QUERIES[key](spark, sf_small)
    res = con.execute(ORACLE[key])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*names).collect())
    assert got == Counter(res.fetchall())
