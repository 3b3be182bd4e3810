"""Every registered query against its DuckDB SQL twin (exact values and dtypes)."""

import pytest

from check_oracle import approx_equal, dtypes_of, duck, rows_of
from conftest import SF_SMALL
from retailyze.plans import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL).toPandas()
    odf = con.sql(ORACLE[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert dtypes_of(sdf) == dtypes_of(odf)
    a, b = rows_of(sdf), rows_of(odf)
    assert a == b or approx_equal(a, b), name
    assert a == b, f"{name}: equal only within 1e-9"


def test_every_query_has_an_oracle_or_is_listed():
    missing = set(QUERIES) - set(ORACLE)
    assert not missing, missing
