"""Literal rows for the semantics that are easy to get wrong."""

import math

from pyspark.sql import functions as F

from fogon import schemas
from fogon.functions import calendar as cal
from fogon.functions.geo import distancia_km, provincia
from fogon.operators import dashboard, dimensions, extract, load, maintenance, search
from fogon.operators.graph import nodes
from fogon.operators.graph.routing import routes
from fogon.sources.warehouse import Warehouse


def one(df):
    return [tuple(r) for r in df.collect()]


def test_province_order_and_bounds(spark):
    casos = [
        (9.9, -84.2, "San José"), (10.15, -84.1, "Cartago"), (10.4, -84.3, "Heredia"), (10.6, -84.5, "Alajuela"),
        (10.6, -85.5, "Guanacaste"), (9.0, -85.0, "Puntarenas"), (9.5, -83.0, "Limón"), (5.0, 5.0, "Sin Ubicación"),
        (None, -84.0, "Sin Ubicación"), (9.6, -85.0, "San José"), (10.1, -84.0, "San José"), (11.2, -84.3, "Sin Ubicación"),
        (10.6, -83.0, "Limón"),
    ]
    df = spark.createDataFrame(casos, "lat double, lng double, esperada string")
    assert df.filter(provincia(F.col("lat"), F.col("lng")) != F.col("esperada")).collect() == []


def test_peak_hours_and_weekdays(spark):
    casos = [
        ("2024-01-01 10:59:00", False, 1, False), ("2024-01-01 11:00:00", True, 1, False), ("2024-01-06 14:59:00", True, 6, True),
        ("2024-01-07 15:00:00", False, 7, True), ("2024-01-01 18:00:00", True, 1, False), ("2024-01-01 21:59:00", True, 1, False),
        ("2024-01-01 22:00:00", False, 1, False),
    ]
    df = spark.createDataFrame(casos, "t string, pico boolean, dia int, finde boolean").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    filas = df.select("pico", cal.es_horario_pico(F.hour("ts")), "dia", cal.dia_semana(F.col("ts")), "finde", cal.es_fin_semana(F.col("ts")))
    assert all(a == b and c == d and e == f for a, b, c, d, e, f in filas.collect())


def test_time_key_is_first_event_of_the_minute(spark):
    df = spark.createDataFrame([(1, "2024-01-01T12:00:40"), (2, "2024-01-01T12:00:05Z"), (3, "2024-01-01T12:01:00")], "id int, t string")
    eventos = df.select("id", cal.to_event_ts(F.col("t")).alias("fecha_hora"))
    vacia = spark.createDataFrame([], schemas.ddl(schemas.DIMENSIONES["dim_tiempo"]))
    ids = dict(one(dimensions.resolve_tiempo(eventos, vacia).select("id", "tiempo_id")))
    assert ids == {1: 1704110405, 2: 1704110405, 3: 1704110460}
    conocida = dimensions.build_dim_tiempo(eventos.filter("id = 1"))
    ids = dict(one(dimensions.resolve_tiempo(eventos, conocida).select("id", "tiempo_id")))
    assert ids == {1: 1704110440, 2: 1704110440, 3: 1704110460}


def test_event_time_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10T02:30:00",)], "t string").select(cal.to_event_ts(F.col("t")).alias("ts"))
    ts = F.col("ts")
    df = df.select(cal.fecha(ts), F.hour(ts), cal.epoch_seconds(ts), cal.iso_text(ts))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(df) == [("2024-03-10", 2, 1710037800, "2024-03-10T02:30:00")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _pedidos(spark, filas):
    return spark.createDataFrame(
        filas, "id_pedido bigint, id_usuario bigint, id_restaurante bigint, id_repartidor bigint, fecha_hora string, estado string, "
        "tipo string, detalles array<struct<id_producto: bigint, cantidad: int, subtotal: double>>")


def _dims(spark):
    usuario = spark.createDataFrame([(1, 9.9, -84.2), (1, 10.6, -85.5), (2, None, None)], "id_usuario bigint, latitud double, longitud double")
    restaurante = spark.createDataFrame([(7, 9.5, -83.0)], "id_restaurante bigint, latitud double, longitud double")
    producto = spark.createDataFrame([(5, "pan", "", 2.0, 1), (6, "té", "Bebida", 0.0, 1)],
                                     "id_producto bigint, nombre string, categoria string, precio double, id_menu bigint")
    return usuario, restaurante, producto


def test_documents_missing_values_and_lookups(spark):
    usuario, restaurante, producto = _dims(spark)
    docs = _pedidos(spark, [
        (1, 1, 7, None, "2024-01-01T12:00:00Z", None, "para recoger", [(5, 2, 3.01), (6, 0, 1.0)]),
        (2, 2, 99, None, None, "listo", "x", [(5, 1, 1.0)]),
        (3, 9, None, 4, "2024-01-02T00:00:00", "listo", "", None),
    ])
    pedidos = {r.id_pedido: r for r in extract.extract_pedidos_doc(docs, usuario, restaurante).collect()}
    assert set(pedidos) == {1, 3}
    assert (pedidos[1].total_pedido, pedidos[1].cantidad_items, pedidos[1].estado, pedidos[1].usuario_latitud) == (4.01, 2, None, 9.9)
    assert (pedidos[3].total_pedido, pedidos[3].cantidad_items, pedidos[3].tipo, pedidos[3].usuario_latitud) == (0.0, 0, "", None)
    lineas = {r.id_producto: r for r in extract.extract_detalle_doc(docs, producto, usuario, restaurante).collect()}
    assert lineas[5].precio_unitario == 1.505 and lineas[5].categoria_producto == ""
    assert lineas[6].precio_unitario == 0.0 and lineas[6].precio_producto is None


def test_relational_defaults_and_cap(spark):
    usuario, restaurante, _ = _dims(spark)
    usuario = usuario.dropDuplicates(["id_usuario"])
    pedido = spark.sql("""select * from values (1L, 1L, 7L, null, timestamp_ntz'2024-01-01 10:00:00', '', 'para recoger'),
        (2L, 2L, 8L, 3L, timestamp_ntz'2024-01-03 10:00:00', 'listo', null), (3L, 2L, 8L, 3L, null, 'listo', null)
        as t(id_pedido, id_usuario, id_restaurante, id_repartidor, fecha_hora, estado, tipo)""")
    detalle = spark.createDataFrame([(1, 5, 2, 0.1), (1, 6, 1, 0.2)], "id_pedido bigint, id_producto bigint, cantidad int, subtotal double")
    filas = {r.id_pedido: r for r in extract.extract_pedidos_rel(pedido, detalle, usuario, restaurante).collect()}
    assert set(filas) == {1, 2}
    assert (filas[1].estado, filas[1].total_pedido, filas[1].cantidad_items) == ("unknown", 0.3, 3)
    assert (filas[2].tipo, filas[2].total_pedido, filas[2].restaurante_latitud) == ("unknown", 0.0, None)
    solo = extract.extract_pedidos_rel(pedido, detalle, usuario, restaurante, limit=1)
    assert one(solo.select("id_pedido")) == [(2,)]


def test_reload_and_source_overlap(spark, tmp_path):
    usuario, restaurante, producto = _dims(spark)
    docs = _pedidos(spark, [(1, 1, 7, None, "2024-01-01T12:00:10Z", "listo", "para recoger", [(5, 2, 3.0), (5, 1, 1.5)])])
    sin_reservas = spark.createDataFrame([], "id_reserva bigint, id_usuario bigint, id_restaurante bigint, fecha_hora timestamp_ntz, estado string")

    def lote(fuente):
        return load.Extracted(
            extract.union_sources(**{fuente: extract.extract_pedidos_doc(docs, usuario, restaurante)}),
            extract.union_sources(**{fuente: extract.extract_reservas_doc(sin_reservas)}),
            extract.union_sources(**{fuente: extract.extract_detalle_doc(docs, producto, usuario, restaurante)}),
        )

    almacen = Warehouse(spark, str(tmp_path / "w"))
    primera = load.run_etl(lote("mongo"), almacen)
    # The same product on two lines of one order stays two rows, but is one product of the dimension.
    assert (primera["fact_pedidos"], primera["fact_detalle_pedidos"], primera["dim_productos"], primera["dim_tiempo"]) == (1, 2, 1, 1)
    assert set(load.run_etl(lote("mongo"), almacen).values()) == {0}
    otra = load.run_etl(lote("postgres"), almacen)
    assert (otra["fact_pedidos"], otra["dim_tiempo"], otra["dim_categorias"]) == (1, 0, 0)
    pedidos = almacen.table("fact_pedidos")
    assert one(pedidos.select("id_pedido", "tiempo_id", "anio", "mes", "provincia_cliente").distinct()) == [(1, 1704110410, 2024, 1, "San José")]
    assert pedidos.count() == 2
    almacen.register("prueba_recarga")
    assert spark.sql("select count(*) from prueba_recarga.fact_detalle_pedidos where anio = 2024").first()[0] == 4


def test_bad_values_are_rejected_and_the_rest_loaded(spark, tmp_path):
    usuario, restaurante, producto = _dims(spark)
    docs = _pedidos(spark, [
        (1, 1, 7, None, "2024-01-01T12:00:10Z", "listo", "para recoger", [(5, 2, 3.0)]),
        (2, 1, 7, None, "2024-01-01T12:00:10Z", "listo", "para recoger", [(5, 2, 150_000_000.0)]),
    ])
    sin_reservas = spark.createDataFrame([], "id_reserva bigint, id_usuario bigint, id_restaurante bigint, fecha_hora timestamp_ntz, estado string")
    lote = load.Extracted(
        extract.union_sources(mongo=extract.extract_pedidos_doc(docs, usuario, restaurante)),
        extract.union_sources(mongo=extract.extract_reservas_doc(sin_reservas)),
        extract.union_sources(mongo=extract.extract_detalle_doc(docs, producto, usuario, restaurante)),
    )
    almacen = Warehouse(spark, str(tmp_path / "w"))
    cargadas = load.run_etl(lote, almacen)
    assert (cargadas["fact_pedidos"], cargadas["fact_detalle_pedidos"]) == (1, 1)
    assert one(almacen.rejects("fact_pedidos").select("id_pedido", "motivo")) == [(2, "total_pedido fuera de rango")]
    assert almacen.table("fact_pedidos").count() == 1


def test_blank_category_is_replaced_at_load_only(spark):
    df = spark.createDataFrame([("",), ("  ",), (None,), ("Postre",)], "c string")
    assert sorted(r[0] for r in df.select(dimensions.categoria_efectiva(F.col("c"))).collect()) == ["Especialidad"] * 3 + ["Postre"]


def test_growth_skips_non_positive_predecessors(spark):
    df = spark.createDataFrame([("2024-01", 100.0), ("2024-02", 150.0), ("2024-03", 0.0), ("2024-04", 30.0)], "periodo string, ingresos double")
    assert one(dashboard.crecimiento_promedio(df)) == [(-25.0,)]


def test_ratios_over_nothing_are_zero(spark):
    base = spark.createDataFrame([(0, 0, 0)], "pedidos_entregados bigint, pedidos_totales bigint, dias_activos bigint")
    assert one(dashboard.kpis_derivados(base)) == [(0.0, 0.0)]


def test_peak_share_with_a_missing_side(spark):
    pico = spark.createDataFrame([(True, 3, 30.0, 10.0, 2)], "es_horario_pico boolean, pedidos bigint, ingresos double, ticket_promedio double, horas_diferentes bigint")
    fila = dashboard.participacion_pico(pico).first()
    assert (fila.pedidos_normal, fila.diferencia_ingresos, fila.participacion_pico_pct) == (0.0, 30.0, 100.0)


def test_flow_matrix_keeps_the_totals(ctx):
    flujos = dashboard.flujos(ctx.pedidos)
    matriz = dashboard.matriz_flujos(flujos)
    sumas = {r[0]: sum(r[1:]) for r in matriz.collect()}
    assert sumas == dict(one(flujos.groupBy("origen").agg(F.sum("pedidos"))))


def test_distance_of_equal_points_is_zero(spark):
    df = spark.range(2000).select((F.col("id") / 100.0 - 10).alias("a"), (F.col("id") / 37.0 - 20).alias("o"))
    peor = df.agg(F.max(distancia_km(F.col("a"), F.col("o"), F.col("a"), F.col("o")))).first()[0]
    assert not math.isnan(peor) and peor < 0.001
    nulo = spark.range(1).select(distancia_km(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0), F.lit(1.0)))
    assert one(nulo) == [(None,)]


def test_route_along_a_line_and_two_stops_at_one_place(spark):
    km = 180 / math.pi / 6371
    paradas = [("pg", 1, u, f"u{u}", d * km, 0.0, 0.0, 0.0) for u, d in ((10, 4.0), (11, 1.0), (12, 2.0), (13, 2.0))]
    df = spark.createDataFrame(paradas, "source_db string, id_repartidor bigint, id_usuario bigint, nombre string, latitud double, longitud double, latitud_actual double, longitud_actual double")
    ruta = routes(df).orderBy("orden").collect()
    assert [r.id_usuario for r in ruta] == [11, 12, 13, 10]
    assert [r.distancia_acumulada for r in ruta] == [1.0, 2.0, 2.0, 4.0]
    assert {(r.total_paradas, r.distancia_total) for r in ruta} == {(4, 4.0)}


def test_node_merge_last_write_wins(spark):
    esquema = "id_restaurante bigint, source_db string, nombre string, latitud double, longitud double, updated_at int"
    viejos = spark.createDataFrame([(1, "pg", "a", 1.0, 1.0, 5), (2, "pg", "b", 1.0, 1.0, 5)], esquema)
    nuevos = spark.createDataFrame([(1, "pg", "a2", 1.0, 1.0, 5), (2, "pg", "b0", 1.0, 1.0, 4), (1, "mongo", "m", None, None, 1)], esquema)
    filas = sorted(one(nodes.merge_nodes("Restaurante", nuevos, viejos).select("id_restaurante", "source_db", "nombre")))
    assert filas == [(1, "mongo", "m"), (1, "pg", "a2"), (2, "pg", "b")]


def test_user_without_coordinates_is_at_zero(spark):
    df = spark.createDataFrame([(1, "pg", "a", None, -84.0, None)], "id_usuario bigint, source_db string, nombre string, latitud double, longitud double, id_referido bigint")
    assert one(nodes.nodes("Usuario", df).select("latitud", "longitud")) == [(0.0, -84.0)]


def test_price_lines_reasons(spark):
    pedidas = spark.createDataFrame([(5, 3), (5, 0), (99, 1), (None, 1)], "id_producto bigint, cantidad int")
    productos = spark.createDataFrame([(5, 1.25)], "id_producto bigint, precio double")
    filas = {(r.id_producto, r.cantidad): (r.subtotal, r.motivo_rechazo) for r in maintenance.price_lines(pedidas, productos).collect()}
    assert filas[(5, 3)] == (3.75, None)
    assert filas[(5, 0)][1] == filas[(None, 1)][1] == maintenance.CANTIDAD_INVALIDA
    assert filas[(99, 1)] == (None, maintenance.PRODUCTO_NO_ENCONTRADO)


def test_search_typo_and_field_weights(spark):
    productos = spark.createDataFrame([
        (1, "Pizza grande", "Comidas", "queso", 10.0, 1), (2, "Pan", "Comidas", "con pizza", 5.0, 1), (3, "Jugo", "Bebidas", None, 2.0, 1),
        (4, "Agua", "Bebidas", "", 1.0, 1),
    ], "id_producto bigint, nombre string, categoria string, descripcion string, precio double, id_menu bigint")
    indice = search.build_search_index(productos)
    assert {r.descripcion for r in indice.filter("id_producto > 2").collect()} == {search.SIN_DESCRIPCION}
    hallados = search.search(indice, search.postings(indice), "piza").collect()
    assert [r.id_producto for r in hallados] == [1, 2] and {r.total for r in hallados} == {2}
    assert [r.id_producto for r in search.search_category(indice, "Bebidas", 1, 10).collect()] == [3, 4]
    assert search.search_category(indice, "bebidas", 1, 10).count() == 0


def test_copurchase_invariants(ctx):
    assert ctx.comprado_con.filter("support > confidence or frecuencia < 1 or confidence > 1").count() == 0


def test_route_is_a_permutation_of_the_stops(ctx):
    ruta = routes(ctx.paradas)
    llave = ["source_db", "id_repartidor", "id_usuario"]
    assert ruta.count() == ctx.paradas.count() == ruta.select(*llave).distinct().join(ctx.paradas, llave).count()
    assert ruta.groupBy("source_db", "id_repartidor").agg(F.max("orden").alias("m"), F.count("*").alias("n")).filter("m <> n").count() == 0
    a, b = ruta.alias("a"), ruta.alias("b")
    saltos = a.join(b, (F.col("a.source_db") == F.col("b.source_db")) & (F.col("a.id_repartidor") == F.col("b.id_repartidor")) & (F.col("b.orden") == F.col("a.orden") + 1))
    assert saltos.filter("b.distancia_acumulada < a.distancia_acumulada").count() == 0


def test_subgraph_keeps_what_has_no_match(spark):
    """A restaurant without orders, an order without lines and an order without a driver all stay."""
    from fogon.operators.graph.delivery import restaurant_subgraph

    def tabla(filas, columnas):
        return spark.createDataFrame(filas, ", ".join(f"{c} {'string' if c == 'source_db' else 'bigint'}" for c in columnas.split()))

    restaurantes = tabla([(1, "pg"), (2, "pg"), (1, "mongo")], "id_restaurante source_db")
    proviene = tabla([(10, 1, "pg"), (11, 1, "pg"), (10, 1, "mongo"), (12, 9, "pg")], "id_pedido id_restaurante source_db")
    contiene = tabla([(10, 5, "pg", 2), (10, 6, "pg", 1), (12, 5, "pg", 1)], "id_pedido id_producto source_db cantidad")
    pertenece = tabla([(10, 7, "pg"), (11, 8, "pg")], "id_pedido id_usuario source_db")
    asignado = tabla([(10, 3, "pg")], "id_pedido id_repartidor source_db")
    todo = {tuple(r) for r in restaurant_subgraph(restaurantes, proviene, contiene, pertenece, asignado).collect()}
    assert todo == {
        (1, "pg", 10, 5, 2, 7, 3), (1, "pg", 10, 6, 1, 7, 3), (1, "pg", 11, None, None, 8, None),
        (1, "mongo", 10, None, None, None, None), (2, "pg", None, None, None, None, None),
    }
    uno = restaurant_subgraph(restaurantes, proviene, contiene, pertenece, asignado, 2)
    assert one(uno) == [(2, "pg", None, None, None, None, None)]


def test_purge_takes_restaurants_of_the_user_and_their_products(spark):
    usuario = spark.createDataFrame([(1,)], "id_usuario bigint")
    tablas = {
        "restaurante": spark.createDataFrame([(1, 1), (2, 5)], "id_restaurante bigint, id_admin bigint"),
        "menu": spark.createDataFrame([(1, 1), (2, 2)], "id_menu bigint, id_restaurante bigint"),
        "producto": spark.createDataFrame([(5, 1), (6, 2)], "id_producto bigint, id_menu bigint"),
        "reserva": spark.createDataFrame([(1, 1, 2), (2, 5, 1), (3, 5, 2)], "id_reserva bigint, id_usuario bigint, id_restaurante bigint"),
        "pedido": _pedidos(spark, [
            (1, 1, 2, None, None, None, None, []), (2, 5, 1, None, None, None, None, []),
            (3, 5, 2, None, None, None, None, [(5, 1, 1.0), (6, 1, 1.0)]), (4, 5, None, None, None, None, None, None),
        ]),
    }
    quedan, resumen = maintenance.purge_users(tablas, usuario)
    assert dict(one(resumen)) == {"reserva": 2, "pedido": 2, "restaurante": 1, "menu": 1, "producto": 1}
    pedidos = {r.id_pedido: r.detalles for r in quedan["pedido"].collect()}
    assert [d.id_producto for d in pedidos[3]] == [6] and pedidos[4] is None and set(pedidos) == {3, 4}
