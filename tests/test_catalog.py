import glob
import math
import os

import duckdb
import pytest

from timberline.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return c


def norm(rows):
    return sorted(repr(tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    assert name in ORACLES
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    got = df.select(*columns).collect()
    assert norm(map(tuple, got)) == norm(want.select(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
