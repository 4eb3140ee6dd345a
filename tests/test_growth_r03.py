"""What the load, the pairs and the index move and hold as tables grow."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from fogon.operators import dimensions as dims
from fogon.operators import load, search
from fogon.operators.graph import copurchase
from fogon.plans import context as ctx
from fogon.plans.context import Context
from fogon.sources.warehouse import Warehouse


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def sin_difusion(spark):
    """Tables as large as those that Spark does not broadcast by itself."""
    clave = "spark.sql.autoBroadcastJoinThreshold"
    antes = spark.conf.get(clave)
    spark.conf.set(clave, "-1")
    yield
    spark.conf.set(clave, antes)


def test_minutes_are_found_without_a_shuffle_of_the_events(spark, sin_difusion):
    t = dt.datetime
    horas = [t(2024, 5, 1, 10, 59, 7), t(2024, 5, 1, 10, 59, 58), t(2024, 5, 1, 11, 0, 0), t(1969, 12, 31, 23, 59, 30), t(2024, 5, 1, 11, 1), None]
    eventos = spark.createDataFrame(list(enumerate(horas)), "id INT, fecha_hora TIMESTAMP_NTZ")
    dim = dims.build_dim_tiempo(eventos.filter("id <> 4"))
    con_id = dims.assign_tiempo(eventos, dim)
    assert con_id.columns == ["id", "fecha_hora", "tiempo_id"] and dict(con_id.dtypes)["tiempo_id"] == "bigint"
    base = 1714561140
    assert {r.id: r.tiempo_id for r in con_id.collect()} == {0: base + 7, 1: base + 7, 2: base + 60, 3: -30, 4: None, 5: None}
    assert "SortMergeJoin" not in _plan(con_id)


def test_rows_that_are_not_staged_are_extracted_once_for_the_key_check(spark, tmp_path):
    almacen = Warehouse(spark, str(tmp_path)).init()
    reservas = spark.range(50).select(
        F.when(F.col("id") != 7, F.col("id")).alias("id_reserva"), F.lit("postgres").alias("fuente_datos"), F.lit(2024).alias("anio"), F.lit(1).alias("mes"))
    almacen.keys("fact_reservas").ensure()
    almacen.keys("fact_reservas").moved(reservas.filter("id_reserva < 40 or id_reserva is null"), 40)
    faltan = dims.only_new_keys(reservas, almacen.keys("fact_reservas"), staged=False)
    assert sorted(r.id_reserva for r in faltan.collect()) == list(range(40, 50))
    assert "LeftSemi" not in _plan(faltan)


def test_rows_are_gathered_by_month_in_their_narrowest_form(spark):
    filas = spark.createDataFrame(
        [(1, 2, dt.datetime(2024, 5, 1, 10, 0), 2.5, "Sopa")], "id_pedido LONG, id_producto LONG, fecha_hora TIMESTAMP_NTZ, subtotal DOUBLE, nombre_producto STRING")
    movidas = load._by_month(filas, "fact_detalle_pedidos")
    assert movidas.columns == ["id_pedido", "id_producto", "subtotal", "fecha_hora", "anio", "mes"]
    assert dict(movidas.dtypes)["subtotal"] == "decimal(10,2)" and "rebalance" in _plan(movidas).lower()


def test_pairs_are_not_joined_with_totals(spark, sin_difusion):
    contiene = spark.createDataFrame([("postgres", p, x) for p in range(4) for x in range(p + 1)], "source_db STRING, id_pedido LONG, id_producto LONG")
    pedidos = contiene.select("source_db", "id_pedido").distinct()
    aristas = copurchase.copurchase(contiene, pedidos)
    filas = {(r.id_producto1, r.id_producto2): (r.frecuencia, r.support, r.confidence) for r in aristas.collect()}
    assert len(filas) == 12 and filas[0, 1] == (3, 0.75, 0.75) and filas[1, 0] == (3, 0.75, 1.0) and filas[3, 0] == (1, 0.25, 1.0)
    assert _plan(aristas).split("Generate", 1)[1].split("HashAggregate", 1)[0].count("SortMergeJoin") == 0


def test_products_are_spread_before_their_words_are_counted(spark):
    indice = spark.createDataFrame([(1, "Sopa sopa", "Entrada", "x", 1.0, 1)], "id_producto LONG, nombre STRING, categoria STRING, descripcion STRING, precio DOUBLE, id_menu LONG")
    tokens = search.postings(indice)
    assert {(r.campo, r.token, r.tf, r.largo) for r in tokens.collect()} == {("nombre", "sopa", 2, 2), ("categoria", "entrada", 1, 1), ("descripcion", "x", 1, 1)}
    assert re.search(r"hashpartitioning\(id_producto#\d+L, \d+\)", _plan(tokens)) and not re.search(r"hashpartitioning\([^)]*campo", _plan(tokens))


def test_written_tables_are_cut_into_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ctx, "FILAS_POR_ARCHIVO", 100)
    c = Context.__new__(Context)
    c.spark, c.carpeta = spark, str(tmp_path)
    c.escrita("pares", spark.range(0, 250, 1, 1))
    assert len(list((tmp_path / "pares").glob("*.parquet"))) == 3
