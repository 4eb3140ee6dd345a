"""Every registered query against its SQL twin, over whole tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points
from fogon.plans import oracle, queries

CONSULTAS, ORACULO = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("nombre", list(CONSULTAS))
def test_same_as_sql(spark, sf_dir, con, nombre):
    assert differences(CONSULTAS[nombre](spark, sf_dir), con, ORACULO[nombre]) == []


def test_every_query_has_a_twin():
    assert set(CONSULTAS) == set(ORACULO)
    assert CONSULTAS.keys() <= entry_points.queries().keys()


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
