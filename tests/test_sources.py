import json

import pytest

from fogon import schemas
from fogon.operators import dimensions
from fogon.sources import export, readers
from fogon.sources.warehouse import Warehouse
from fogon.streaming.incremental import stream_feed


def test_osm_file(spark, tmp_path):
    def nodo(tags, tipo="node"):
        return {"type": tipo, "lat": 9.9, "lon": -84.1, "tags": tags}

    elementos = [
        nodo({"amenity": "restaurant", "name": "Uno", "addr:full": "A", "addr:street": "B"}),
        nodo({"amenity": "restaurant", "name": "Dos", "addr:street": "B"}),
        nodo({"amenity": "restaurant", "name": "Tres", "addr:city": "Heredia"}),
        nodo({"amenity": "restaurant", "name": "Cuatro"}),
        nodo({"amenity": "restaurant", "name": "   "}), nodo({"amenity": "restaurant"}), nodo({"amenity": "bar", "name": "X"}),
        nodo({"amenity": "restaurant", "name": "Vía"}, "way"), {"type": "node", "lat": 1.0, "lon": 1.0},
    ]
    archivo = tmp_path / "restaurantes.json"
    archivo.write_text(json.dumps({"version": 0.6, "elements": elementos}, indent=1))
    filas = {r.nombre: r.direccion for r in readers.read_osm_restaurants(spark, str(archivo)).collect()}
    assert filas == {"Uno": "A", "Dos": "B", "Tres": "Heredia, Costa Rica", "Cuatro": "San José, Costa Rica"}


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("split", [41, 700, 10**6])
def test_map_export_in_splits(spark, tmp_path, indent, split):
    """Braces, quotes and backslashes in strings, elements without tags, header objects; the splits cut anywhere."""
    raros = ["Uno", "a}b", "{", "}{\\", 'dice "x}"', "\\\"}", "\n}", "ñandú }", "", "]}", "\\"]
    elementos = []
    for i in range(150):
        e = {"type": "node", "lat": 9 + i / 1000, "lon": -84 - i / 1000}
        if i % 4:
            e["tags"] = {"amenity": "restaurant", "name": f"{raros[i % len(raros)]} {i}", raros[i % 7]: raros[i % 5]}
        if i % 9 == 0:
            e["members"] = [{"ref": {"x": i}}, {}]
        elementos.append(e)
    carpeta = tmp_path / "osm"
    carpeta.mkdir()
    for nombre, parte in (("a", elementos[:100]), ("b", elementos[100:]), ("c", [])):
        exporte = {"version": 0.6, "generator": "Over{pass", "osm3s": {"copyright": "}"}, "elements": parte}
        veces = 2 if nombre == "b" else 1
        (carpeta / f"{nombre}.json").write_text((json.dumps(exporte, indent=indent, ensure_ascii=False) + "\n") * veces)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        leidos = readers.map_elements(spark, str(carpeta)).filter("type is not null").collect()
        tramos = spark.read.option("lineSep", "}").text(str(carpeta)).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tramos > 1 or split == 10**6
    dicho = sorted((r.lat, r.lon, r.type, sorted((r.tags or {}).items())) for r in leidos)
    assert dicho == sorted((e["lat"], e["lon"], e["type"], sorted(e.get("tags", {}).items())) for e in elementos + elementos[100:])


def test_payload(spark, tmp_path):
    archivo = tmp_path / "usuarios.json"
    archivo.write_text(json.dumps({"message": "ok", "total": 2, "usuarios": [
        {"id_usuario": 1, "nombre": "a", "latitud": 9.9, "longitud": -84}, {"id_usuario": 2, "nombre": "b", "id_referido": 1}]}))
    assert sorted((r.id_usuario, r.id_referido) for r in readers.read_payload(spark, str(archivo)).collect()) == [(1, None), (2, 1)]


def test_relational_parquet(spark, sf_dir):
    assert readers.read_relational(spark, "nation.parquet", {"path": sf_dir}).count() == 25


def test_cubes_by_name_in_another_session(spark, tmp_path):
    almacen = Warehouse(spark, f"{tmp_path}/w").init()
    for n in (3, 5, 7):
        almacen.register("cubos_prueba", {"cubo": spark.range(n).toDF("mes")})
        assert spark.newSession().table("cubos_prueba.cubo").count() == n
    assert sorted(p.name for p in (tmp_path / "w" / "_cubos" / "cubo").iterdir()) == ["00000002", "00000003"]
    almacen.register("cubos_prueba", {"cubo": spark.range(4).selectExpr("id as mes", "'x' as b")})
    assert spark.newSession().table("cubos_prueba.cubo").columns == ["mes", "b"]
    assert spark.newSession().sql("select count(*) from cubos_prueba.dim_ubicacion").first()[0] == 8


@pytest.mark.parametrize("bounds", [(1, 100, 8), (-7, 12, 64), (5, 5, 4), (None, None, 4), (0, 10**12, 3)])
def test_key_ranges_take_every_row_once(spark, bounds):
    menor, mayor, partes = bounds
    condiciones = readers.key_ranges("k", *bounds)
    assert 1 <= len(condiciones) <= partes
    valores = [None, *range(-20, 120), 10**12 // 3, 10**12, 10**12 + 5]
    filas = spark.createDataFrame([(v,) for v in valores], "k long")
    veces = filas.selectExpr(*[f"case when {c} then 1 else 0 end as c{i}" for i, c in enumerate(condiciones)])
    assert {sum(r) for r in veces.collect()} == {1}
    if menor == 1:
        dentro = filas.filter("k between 1 and 100")
        assert {12, 13} == {dentro.filter(c).count() for c in condiciones}


def test_csv_sections(spark, tmp_path):
    rutas = export.export_csv({"a": spark.range(3).toDF("x"), "b": spark.range(2).toDF("y")}, str(tmp_path))
    assert spark.read.option("header", "true").csv(rutas["a"]).columns == ["x"]
    assert spark.read.option("header", "true").csv(rutas["b"]).count() == 2


def test_incremental_load_and_replay(spark, ctx, tmp_path):
    """Files that arrive later are added; the same feed with a fresh checkpoint adds nothing."""
    feed = str(tmp_path / "feed")
    docs = ctx.src.pedido_doc.withColumn("fecha_hora", ctx.src.pedido_doc.fecha_hora.cast("string"))
    docs.filter("id_pedido % 2 = 0").coalesce(1).write.json(feed)
    almacen = Warehouse(spark, str(tmp_path / "w")).init()

    def correr(punto, kind="pedidos", carpeta=feed):
        stream_feed(spark, kind, carpeta, almacen, ctx.documental, str(tmp_path / punto), max_files=1).awaitTermination()
        return tuple(almacen.table(t).count() for t in schemas.HECHOS)

    pares = correr("cp")
    assert pares[0] == docs.filter("id_pedido % 2 = 0").count() and pares[1] == 0
    docs.filter("id_pedido % 2 = 1").coalesce(1).write.mode("append").json(feed)
    todos = correr("cp")
    assert todos == (docs.count(), 0, ctx.src.de_fuente("detalle", "mongo").count())
    assert correr("otro_cp") == todos
    reservas = str(tmp_path / "reservas")
    ctx.src.de_fuente("reserva", "mongo").coalesce(1).write.json(reservas)
    assert correr("cp_r", "reservas", reservas) == (todos[0], ctx.src.de_fuente("reserva", "mongo").count(), todos[2])


def test_small_batch_does_not_shuffle_the_target(spark, ctx, tmp_path):
    lote = ctx.pedidos.filter("id_pedido < 40").select("id_pedido", "fuente_datos")
    lote.unionAll(spark.sql("select -1L, 'mongo'")).write.parquet(str(tmp_path / "lote"))
    nuevas = dimensions.only_new(spark.read.parquet(str(tmp_path / "lote")), ctx.pedidos, schemas.CLAVES["fact_pedidos"])
    assert [tuple(r) for r in nuevas.collect()] == [(-1, "mongo")]
    plan = nuevas._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "SortMergeJoin" not in plan
