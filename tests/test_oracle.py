"""Every registered query against its SQL oracle on the small fixture."""

import pytest

import __spark_entry__ as E
from starledger.oracle import ORACLE
from starledger.plans import catalog
from oracle_compare import SF_SMALL, duck, rows_of

NAMES = sorted(catalog.registry())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = catalog.registry()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLE[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_rows, sdf.columns) == rows_of(d_rows, d_cols)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["customer_id", "cliente", "pais", "segmento", "ingresos", "pedidos",
                          "ticket_promedio"]
