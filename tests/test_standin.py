"""Every stand-in source table renders to the same rows in Spark and in DuckDB."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import TABLES, digest  # noqa: E402
from shelfspark.sources import standin  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(standin.ALL))
def test_standin_same_in_both_engines(spark, duck, name):
    df = standin.spark_table(spark, SF, name)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(f"SELECT * FROM ({standin.duckdb_sql(name)})")
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert df.columns == ocols
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


@pytest.mark.parametrize("name", sorted(n for n, t in standin.ALL.items() if any(p.by for p in t.parts)))
def test_only_the_keys_of_a_distinct_are_shuffled(spark, name):
    plan = standin.spark_table(spark, SF, name)._jdf.queryExecution().executedPlan().toString()
    grouped = [line.split("keys=[")[1].split("]")[0] for line in plan.splitlines() if "HashAggregate(keys=[" in line]
    assert grouped and all(len(g.split(",")) <= 3 for g in grouped)
