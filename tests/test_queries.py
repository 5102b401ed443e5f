import os

import duckdb
import pytest

from parallax.plans import catalogue

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(DIR):
        con.execute(f"create view {f[:-8]} as select * from '{DIR}/{f}'")
    df = catalogue.QUERIES[name](spark, DIR)
    names = sorted(df.columns)
    order = lambda r: [(x is None, str(x)) for x in r]
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=order)
    quoted = ", ".join(f'"{c}"' for c in names)
    assert got == sorted(con.execute(f"select {quoted} from ({catalogue.ORACLE_SQL[name]})").fetchall(), key=order)
