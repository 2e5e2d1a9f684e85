"""Every registered query equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from retail_mart.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.helpers import duck, frame_rows, oracle_rows

KEYS = sorted(set(QUERIES) & set(E.oracle_sql()))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)




def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(KEYS)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "low_stock_flg_wk" in df.columns


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    """Values, column names and column types."""
    df = E.queries()[key](spark, SF_SMALL)
    sql = E.oracle_sql()[key]
    cols, expected = oracle_rows(con, sql)
    assert sorted(df.columns) == sorted(cols)
    got = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
           for f in df.schema.fields}
    rel = con.sql(sql)
    assert got == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert frame_rows(df) == expected
