"""Every registered query with SQL against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def clean(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


@pytest.mark.parametrize("name", [n for n in __spark_entry__.oracle_sql()])
def test_same_as_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(clean(r[c]) for c in columns) for r in df.collect()), key=repr)
    res = duck.execute(__spark_entry__.oracle_sql()[name])
    names = [x[0] for x in res.description]
    assert sorted(names) == columns
    want = sorted((tuple(clean(r[names.index(c)]) for c in columns) for r in res.fetchall()), key=repr)
    assert got == want


def test_entry_has_rows(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["bldg_id", "dist_to_water_m", "water_len_density_250m", "water_len_density_500m", "water_len_density_1000m"]
    assert df.count() == 1500
