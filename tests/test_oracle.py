"""Every registered query against its SQL oracle (DuckDB) at sf0.001:
same columns, same row count, same multiset of values."""

import duckdb
import pytest

from conftest import SF_SMALL
from tools.oracle_check import TABLES, digest
import pandas as pd



from starloom.plans.registry import load

QUERIES, ORACLE = load()



@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_declared_rows_only():
    assert set(QUERIES) - set(ORACLE) == {"schema_profile"}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    got = pd.DataFrame.from_records([tuple(r) for r in sdf.collect()], columns=sdf.columns)
    want = con.execute(ORACLE[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got)[0] == digest(want)[0]
