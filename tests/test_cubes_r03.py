"""What facts grouped by time move: distinct counts apart from sums, days by number."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from fogon.functions.measures import por_tiempo

DIA = ["fecha", "anio", "mes", "trimestre", "dia_semana", "es_fin_semana"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def hechos(spark):
    base = int(dt.datetime(2024, 3, 30, tzinfo=dt.timezone.utc).timestamp())
    filas = [(z, base + s, 2024, 3, u, r, m) for z, s, u, r, m in [
        ("a", 60, 1, 1, 5), ("a", 120, 1, 2, None), ("a", 86400, 2, 2, 7), (None, 60, None, 1, 1), (None, 90, None, None, None), ("b", 2 * 86400, 3, 3, 2)]]
    filas.append(("a", None, 2024, 3, 9, 9, 9))
    return spark.createDataFrame(filas, "z STRING, tiempo_id LONG, anio INT, mes INT, u LONG, r LONG, m INT")


def test_distinct_counts_do_not_multiply_the_rows_with_their_sums(hechos):
    cubo = por_tiempo(hechos, ["z"], ["anio", "mes"], {"monto": F.col("m")}, {"us": F.col("u"), "rs": F.col("r")}, {"dias": "fecha"})
    assert cubo.columns == ["z", "anio", "mes", "monto", "us", "rs", "dias"]
    assert {tuple(r) for r in cubo.collect()} == {("a", 2024, 3, 12, 2, 2, 2), (None, 2024, 3, 1, 0, 1, 1), ("b", 2024, 3, 2, 1, 1, 1)}
    multiplicadas = [x for x in _plan(cubo).splitlines() if " Expand " in x or "Expand [" in x]
    assert multiplicadas and not any("monto" in x for x in multiplicadas)


def test_days_are_grouped_by_number(hechos):
    cubo = por_tiempo(hechos, [], DIA, {"monto": F.col("m")}, {"us": F.col("u")})
    assert {tuple(r) for r in cubo.collect()} == {
        ("2024-03-30", 2024, 3, 1, 6, True, 6, 1), ("2024-03-31", 2024, 3, 1, 7, True, 7, 1), ("2024-04-01", 2024, 3, 2, 1, False, 2, 1)}
    assert not re.search(r"hashpartitioning\([^)]*fecha", _plan(cubo))


def test_no_rows_give_one_row_without_keys(hechos):
    assert [tuple(r) for r in por_tiempo(hechos.limit(0), [], [], {"monto": F.col("m")}, {"us": F.col("u")}).collect()] == [(None, 0)]
