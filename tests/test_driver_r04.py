"""What reaches the driver and stays on disk: no node table is broadcast, however small its files are; shuffles go with their write; old rows are not extracted."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from fogon.functions import sizing
from fogon.operators import extract, load
from fogon.operators.graph import copurchase, delivery, nodes
from fogon.plans.context import context
from fogon.sources.warehouse import Warehouse


@pytest.fixture(scope="module")
def grafo(spark, tmp_path_factory):
    """Written tables of a few kilobytes each; Spark takes them for small ones."""
    base = tmp_path_factory.mktemp("grafo")

    def escrita(nombre, df):
        df.write.parquet(f"{base}/{nombre}")
        return spark.read.parquet(f"{base}/{nombre}").select("*", F.explode(F.array(F.lit("postgres"), F.lit("mongo"))).alias("source_db"))

    k = F.col("id")
    return {
        "pedido": escrita("pedido", spark.range(50).select(k.alias("id_pedido"), (k % 5).alias("id_restaurante"), (k % 9).alias("id_usuario"),
                                                           (k % 4).alias("id_repartidor"), F.lit("listo").alias("estado"))),
        "linea": escrita("linea", spark.range(150).select((k % 50).alias("id_pedido"), k.alias("id_detalle"), (k % 12).alias("id_producto"),
                                                          (k % 3).cast("int").alias("cantidad"))),
        "producto": escrita("producto", spark.range(10).select(k.alias("id_producto"), F.concat(F.lit("p"), k).alias("nombre"), F.lit("c").alias("categoria"),
                                                               k.cast("double").alias("precio"))),
        "usuario": escrita("usuario", spark.range(8).select(k.alias("id_usuario"), F.lit("u").alias("nombre"), F.lit(9.0).alias("latitud"),
                                                            F.lit(-84.0).alias("longitud"), (k + 5).alias("id_referido"))),
        "restaurante": escrita("restaurante", spark.range(4).select(k.alias("id_restaurante"), F.lit("r").alias("nombre"), F.lit(9.0).alias("latitud"),
                                                                    (k / 10 - 84).alias("longitud"))),
        "repartidor": escrita("repartidor", spark.range(3).select(k.alias("id_repartidor"), F.lit("d").alias("nombre"), F.lit("disponible").alias("estado"),
                                                                  F.lit(9.0).alias("latitud_actual"), (k / 10 - 84).alias("longitud_actual"))),
    }


def _plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_nodes_are_not_broadcast_for_edges(grafo):
    g = grafo
    contiene = nodes.edges_contiene(g["linea"], g["pedido"], g["producto"])
    proviene = nodes.edges_proviene(g["pedido"], g["pedido"], g["restaurante"])
    pertenece = nodes.edges_pertenece(g["pedido"], g["pedido"], g["usuario"])
    asignado = nodes.edges_asignado(g["pedido"], g["pedido"], g["repartidor"])
    refiere = nodes.edges_refiere(g["usuario"])
    paradas = delivery.delivery_stops(delivery.users_by_driver(g["pedido"], g["usuario"]), g["repartidor"])
    distancias = delivery.driver_distances(g["restaurante"], g["repartidor"], 2)
    subgrafo = delivery.restaurant_subgraph(g["restaurante"], proviene, contiene, pertenece, asignado)
    for df in (contiene, proviene, pertenece, asignado, refiere, paradas):
        assert "BroadcastHashJoin" not in _plan(df)
    # Restaurants without orders are found by their few distinct keys, not by the nodes.
    assert not [x for x in _plan(subgrafo).split("\n") if "BroadcastHashJoin" in x and "LeftAnti" not in x and "id_restaurante" in x]
    assert not [x for x in _plan(distancias).split("\n") if "BroadcastHashJoin" in x and "id_repartidor" in x]
    # The last line of an order's product counts; products 10 and 11, user 8, restaurant 4 and driver 3 do not exist.
    esperadas = {}
    for d in range(150):
        if d % 12 < 10:
            esperadas[d % 50, d % 12] = d % 3
    for fuente in ("postgres", "mongo"):
        filas = contiene.filter(F.col("source_db") == fuente).collect()
        assert {(r.id_pedido, r.id_producto): r.cantidad for r in filas} == esperadas and len(filas) == len(esperadas)
    assert {(r.id_pedido, r.id_restaurante, r.source_db) for r in proviene.collect()} == {(p, p % 5, s) for p in range(50) if p % 5 < 4 for s in ("postgres", "mongo")}
    assert pertenece.count() == 2 * sum(p % 9 < 8 for p in range(50))
    assert asignado.count() == 2 * sum(p % 4 < 3 for p in range(50))
    assert {(r.id_referente, r.id_referido) for r in refiere.collect()} == {(u + 5, u) for u in range(3)}

def test_large_products_are_not_broadcast_to_edges(spark, grafo, monkeypatch):
    aristas = spark.createDataFrame([(1, 2, "postgres", 3, 0.5, 0.5), (2, 1, "postgres", 3, 0.5, 0.4), (3, 9, "mongo", 1, 0.1, 0.9)],
                                    "id_producto1 long, id_producto2 long, source_db string, frecuencia long, support double, confidence double")
    assert "BroadcastHashJoin" not in _plan(copurchase.combos_by_price(aristas, grafo["producto"]))
    pocas = copurchase.recommend(aristas, grafo["producto"], "p", 5).collect()
    monkeypatch.setattr(sizing, "FILAS_A_DIFUNDIR", 3)
    muchas = copurchase.recommend(aristas, grafo["producto"], "p", 5)
    assert not [x for x in _plan(muchas).split("\n") if "Broadcast" in x and "LeftSemi" in x]
    assert muchas.collect() == pocas and len(pocas) == 3


def _shuffle_files(spark) -> int:
    archivos = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(archivos.apply(i).getName().startswith("shuffle_") for i in range(archivos.size()))


def test_shuffles_go_after_each_write_of_a_context(spark, ctx, tmp_path):
    context(spark, ctx.src.sf_dir)
    antes = _shuffle_files(spark)
    df = spark.range(1000).repartition(7, "id")
    df.write.parquet(f"{tmp_path}/a")
    fin = time.time() + 20
    while _shuffle_files(spark) > antes and time.time() < fin:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= antes
    # What is run again makes its shuffles again.
    assert sorted(r.id for r in df.collect()) == sorted(r.id for r in df.collect()) == list(range(1000))


def test_second_load_compares_keys_before_it_extracts_rows(spark, tmp_path, monkeypatch):
    def reservas(ids):
        return spark.createDataFrame(
            [(i, 1, 2, dt.datetime(2024, 5, 1 + (i or 0) % 9, 10, 0), "confirmada", f) for i, f in ids],
            "id_reserva long, id_usuario long, id_restaurante long, fecha_hora timestamp_ntz, estado string, fuente_datos string")

    k = F.lit(None)
    pedidos = reservas([]).select(*[k.cast("bigint").alias(c) for c in ("id_pedido", "id_usuario", "id_restaurante", "id_repartidor")], "fecha_hora", "estado",
                                  F.col("estado").alias("tipo"), k.cast("double").alias("total_pedido"), k.cast("bigint").alias("cantidad_items"),
                                  *[k.cast("double").alias(c) for c in extract.COORDENADAS], "fuente_datos")
    lineas = reservas([]).select(*[(F.col(c) if c in ("fecha_hora",) else k.cast("string" if c.startswith(("nombre", "categoria", "estado", "tipo")) else "double" if c in (
        *extract.COORDENADAS, "subtotal", "precio_unitario", "precio_producto") else "bigint")).alias(c) for c in extract.DETALLE], "fuente_datos")
    almacen = Warehouse(spark, str(tmp_path))
    planes = []
    de_veras = Warehouse.stage
    monkeypatch.setattr(Warehouse, "stage", lambda self, df, nombre, *a: (planes.append((nombre, df._jdf.queryExecution().optimizedPlan().toString())), de_veras(self, df, nombre, *a))[1])
    primeras = [(1, "postgres"), (1, "postgres"), (1, "mongo"), (2, "postgres"), (None, "mongo")]

    def cargadas(ids):
        planes.clear()
        return load.run_etl(load.Extracted(pedidos, reservas(ids), lineas), almacen)["fact_reservas"]

    assert cargadas(primeras) == 5
    assert cargadas(primeras) == 0
    # Whole rows were not even compared.
    assert all("Join" not in plan for nombre, plan in planes if nombre == "fact_reservas")
    assert any("Join" in plan for nombre, plan in planes if nombre == "claves_fact_reservas")
    # Old keys are left out, repeated new ones stay, a null id is a key of its own in each source.
    assert cargadas([*primeras, (3, "mongo"), (3, "mongo"), (None, "postgres")]) == 3
    filas = sorted((r.id_reserva or 0, r.fuente_datos) for r in almacen.table("fact_reservas").collect())
    assert filas == sorted([*((i or 0, f) for i, f in primeras), (3, "mongo"), (3, "mongo"), (0, "postgres")])


def test_many_users_and_products_are_not_broadcast_to_the_load(spark, ctx, monkeypatch):
    def joins(extraido):
        return [x for df in (extraido.pedidos, extraido.detalle) for x in _plan(df).split("\n") if "BroadcastHashJoin" in x and "id_usuario" in x]

    pocos = load.extract_all(ctx.relacional, ctx.documental)
    def catalogo(extraido):
        """Joins of the catalog with the relational source's lines, when keys alone are extracted."""
        claves = extraido.detalle.select("id_pedido", "id_producto", "fuente_datos")
        return [x for x in _plan(claves).split("\n") if "BroadcastHashJoin" in x and "id_producto" in x]

    assert joins(pocos) and catalogo(pocos)
    monkeypatch.setattr(sizing, "FILAS_A_DIFUNDIR", 3)
    muchos = load.extract_all(ctx.relacional, ctx.documental)
    assert not joins(muchos) and not catalogo(muchos)
    for a, b in ((pocos.pedidos, muchos.pedidos), (pocos.detalle, muchos.detalle)):
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
