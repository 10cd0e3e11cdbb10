"""Every registered query against its DuckDB twin on the smallest fixture."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import digest  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from sparkcare.sources.tables import TABLE_NAMES  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = {k: v for k, v in oracle_sql().items() if not k.startswith("op")}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "patient_id" in df.columns


@pytest.mark.skipif(not os.path.isdir(SF), reason="fixture tables absent")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_every_query_of_the_reference_operators_has_a_twin():
    from sparkcare.plans.registry import all_oracle_sql, all_queries
    assert set(all_oracle_sql()) == set(all_queries())
