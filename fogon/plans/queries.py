
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon import schemas
from fogon.operators import cubes, dashboard, extract, load, maintenance, operations, refresh, report, search
from fogon.operators import dimensions as dims
from fogon.operators.graph import copurchase, delivery, influence, nodes, routing
from fogon.operators.search_index import SearchIndex
from fogon.plans.context import Context, context
from fogon.sources import export, readers, warehouse

Query = Callable[[Context], DataFrame]
REGISTRO: dict[str, Query] = {}


def query(nombre: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        REGISTRO[nombre] = fn
        return fn

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(context(spark, sf_dir))

    return {nombre: bind(fn) for nombre, fn in REGISTRO.items()}


def _texto_lineas(detalles: str = "detalles") -> Column:
    """Embedded lines as text, so that whole arrays can be compared."""
    linea = F.transform(
        detalles,
        lambda d: F.concat_ws(":", d.id_producto.cast("string"), d.cantidad.cast("string"),
                              d.subtotal.cast("decimal(12,2)").cast("string")),
    )
    return F.array_join(linea, ",")


# --- Sources and sinks --------------------------------------------------------------------------------


@query("S01")
def _(c: Context) -> DataFrame:
    """Rows of each of the eight tables; repartidor and menu have no file of their own and are exported first."""
    archivos = {"usuario": "customer", "restaurante": "supplier", "producto": "part", "pedido": "orders", "detalle": "lineitem", "reserva": "events"}
    total = None
    for tabla in schemas.RELACIONALES:
        if tabla in archivos:
            df = readers.read_relational(c.spark, f"{archivos[tabla]}.parquet", {"path": c.src.sf_dir})
        else:
            c.escrita(f"relacional/{tabla}", c.relacional[tabla])
            df = readers.read_relational(c.spark, tabla, {"path": f"{c.carpeta}/relacional"})
        fila = df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(tabla).alias("tabla"), "filas")
        total = fila if total is None else total.unionAll(fila)
    return total


def _json(c: Context, nombre: str, df: DataFrame) -> str:
    ruta = f"{c.carpeta}/json_{nombre}"
    df.write.mode("overwrite").json(ruta)
    return ruta


def _documentos(c: Context) -> DataFrame:
    return c.src.pedido_doc.withColumn("fecha_hora", F.concat(F.replace(F.col("fecha_hora").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z")))


@query("S02")
def _(c: Context) -> DataFrame:
    docs = readers.read_documents(c.spark, _json(c, "pedidos", _documentos(c)), schemas.PEDIDO_DOC)
    return docs.select("id_pedido", "id_usuario", "estado", F.size("detalles").alias("lineas"), _texto_lineas().alias("detalle"))


@query("S03")
def _(c: Context) -> DataFrame:
    u = c.src.usuario
    usuario = F.struct("id_usuario", "nombre", "latitud", "longitud", "id_referido")
    # One response per block of ids, as a paged API would answer.
    respuestas = u.groupBy(F.floor(F.col("id_usuario") / 50).alias("pagina")).agg(
        F.lit("ok").alias("message"), F.count(F.lit(1)).alias("total"), F.collect_list(usuario).alias("usuarios")
    ).drop("pagina")
    return readers.read_payload(c.spark, _json(c, "usuarios", respuestas))


@query("S04")
def _(c: Context) -> DataFrame:
    k = F.col("s_suppkey")
    nombre = F.when(k % 7 == 3, F.lit("  ")).otherwise(F.col("s_name"))
    elementos = c.src.raw("supplier").select(
        F.floor(k / 500).alias("bloque"),
        F.when(k % 5 == 4, "way").otherwise("node").alias("type"),
        (F.lit(9.0) + k / 1000.0).alias("lat"), (F.lit(-84.0) - k / 1000.0).alias("lon"),
        F.map_from_arrays(
            F.array(F.lit("amenity"), F.lit("name"), F.when(k % 3 == 0, "addr:full").when(k % 3 == 1, "addr:city").otherwise("x")),
            F.array(F.when(k % 11 == 5, "bar").otherwise("restaurant"), nombre, F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))),
        ).alias("tags"),
    )
    # One export per block of ids, several exports in a file.
    exportes = elementos.groupBy("bloque").agg(F.collect_list(F.struct("type", "lat", "lon", "tags")).alias("elements")).drop("bloque")
    return readers.read_osm_restaurants(c.spark, _json(c, "osm", exportes))


@query("S05")
def _(c: Context) -> DataFrame:
    c.pedidos.createOrReplaceTempView("fact_pedidos_s05")
    c.tiempo.createOrReplaceTempView("dim_tiempo_s05")
    return warehouse.query(
        c.spark,
        "SELECT t.anio, count(*) AS pedidos, cast(sum(p.total_pedido) AS double) AS ingresos "
        "FROM fact_pedidos_s05 p JOIN dim_tiempo_s05 t USING (tiempo_id) GROUP BY t.anio",
    )


def _filas(spark: SparkSession, database: str, tablas: list[str]) -> DataFrame:
    total = None
    for tabla in tablas:
        fila = spark.table(f"{database}.{tabla}").agg(F.count(F.lit(1)).alias("filas")).select(F.lit(tabla).alias("tabla"), "filas")
        total = fila if total is None else total.unionAll(fila)
    return total


@query("S06")
def _(c: Context) -> DataFrame:
    base = f"w_{c.carpeta.rsplit('-', 1)[-1]}"
    c.almacen.register(base)
    return _filas(c.spark, base, list(schemas.TABLAS))


@query("S06_cubos")
def _(c: Context) -> DataFrame:
    """Rows of the cubes that were published to the catalog, read by name."""
    base = f"w_{c.carpeta.rsplit('-', 1)[-1]}"
    c.almacen.register(base, {n: c.cubo(n) for n in CUBOS})
    return _filas(c.spark, base, CUBOS)


@query("S07")
def _(c: Context) -> DataFrame:
    """Seeded locations with the orders whose client the given province boxes hold."""
    conteo = c.pedidos.groupBy(F.col("provincia_cliente").alias("provincia")).agg(F.count(F.lit(1)).alias("pedidos"))
    cajas = [F.col(x).cast("double").alias(x) for x in ("latitud_min", "latitud_max", "longitud_min", "longitud_max")]
    return warehouse.seed_ubicacion(c.spark).join(conteo, "provincia", "left").select(
        "ubicacion_id", "provincia", *cajas, "es_zona_activa", F.coalesce("pedidos", F.lit(0)).alias("pedidos")
    )


@query("S08")
def _(c: Context) -> DataFrame:
    destino = warehouse.Warehouse(c.spark, f"{c.carpeta}/escritura").init()
    nuevas = dims.only_new(c.pedidos, destino.table("fact_pedidos"), schemas.CLAVES["fact_pedidos"])
    warehouse.write_fact(destino, nuevas, "fact_pedidos")
    return destino.table("fact_pedidos").groupBy("anio", "mes").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("total_pedido").cast("double").alias("ingresos")
    )


@query("S09")
def _(c: Context) -> DataFrame:
    por_hora = dashboard.por_hora(c.pedidos, c.tiempo)
    rutas = export.export_csv({"horas": por_hora, "periodos": dashboard.por_periodo_dia(por_hora)}, f"{c.carpeta}/csv")
    horas = c.spark.read.option("header", "true").schema(
        "hora INT, periodo_dia STRING, pedidos BIGINT, ingresos DOUBLE, ticket_promedio DOUBLE, usuarios_activos BIGINT"
    ).csv(rutas["horas"])
    return horas


# --- ETL ----------------------------------------------------------------------------------------------


@query("E01")
def _(c: Context) -> DataFrame:
    r = c.relacional
    return extract.extract_pedidos_rel(r["pedido"], r["detalle"], r["usuario"], r["restaurante"])


@query("E02")
def _(c: Context) -> DataFrame:
    d = c.documental
    return extract.extract_pedidos_doc(d["pedido"], d["usuario"], d["restaurante"])


@query("E03")
def _(c: Context) -> DataFrame:
    return extract.extract_reservas_rel(c.relacional["reserva"])


@query("E04")
def _(c: Context) -> DataFrame:
    return extract.extract_reservas_doc(c.documental["reserva"])


@query("E05")
def _(c: Context) -> DataFrame:
    r = c.relacional
    return extract.extract_detalle_rel(
        r["detalle"], r["pedido"], r["producto"], r["menu"], r["restaurante"], r["usuario"]
    )


@query("E06")
def _(c: Context) -> DataFrame:
    d = c.documental
    return extract.extract_detalle_doc(d["pedido"], d["producto"], d["usuario"], d["restaurante"]).withColumn(
        "precio_unitario", F.round("precio_unitario", 2)
    )


def _con_huecos(c: Context) -> DataFrame:
    """Orders with missing states, types, totals and times."""
    k = F.col("id_pedido")
    return c.src.pedido.select(
        "id_pedido", "id_usuario",
        F.when(k % 13 == 0, "").when(k % 17 == 0, None).otherwise(F.col("estado")).alias("estado"),
        F.when(k % 11 == 0, None).otherwise(F.col("tipo")).alias("tipo"),
        F.when(k % 5 == 0, None).otherwise(k % 1000).cast("double").alias("total_pedido"),
        F.when(k % 19 == 0, None).otherwise(F.col("fecha_hora")).alias("fecha_hora"),
    )


@query("E07")
def _(c: Context) -> DataFrame:
    return extract.normalize_extract(_con_huecos(c), "relational").drop("fecha_hora")


@query("E08")
def _(c: Context) -> DataFrame:
    return extract.require_timestamp(_con_huecos(c)).select("id_pedido", "fecha_hora")


@query("E09")
def _(c: Context) -> DataFrame:
    from fogon.functions.calendar import iso_text, to_event_ts

    texto = F.concat(iso_text(F.col("ts")), F.when(F.col("event_id") % 2 == 0, F.lit("Z")).otherwise(F.lit("")))
    texto = F.when(F.col("event_id") % 10 == 3, F.lit("sin fecha")).otherwise(texto)
    return c.src.raw("events").select(F.col("event_id").alias("id_reserva"), to_event_ts(texto).alias("fecha_hora"))


@query("E10")
def _(c: Context) -> DataFrame:
    return extract.union_sources(
        postgres=extract.extract_reservas_rel(c.relacional["reserva"]),
        mongo=extract.extract_reservas_doc(c.documental["reserva"]),
    ).groupBy("fuente_datos", "estado").agg(F.count(F.lit(1)).alias("filas"), F.min("fecha_hora").alias("primera"))


def _eventos(c: Context) -> DataFrame:
    return c.src.pedido.select("fecha_hora").unionAll(c.src.reserva.select("fecha_hora"))


@query("E11")
def _(c: Context) -> DataFrame:
    return dims.build_dim_tiempo(_eventos(c))


@query("E12")
def _(c: Context) -> DataFrame:
    """Ids for all reservations against a dimension that only knows the minutes of half of them."""
    conocidos = dims.build_dim_tiempo(c.src.reserva.filter(F.col("id_reserva") % 2 == 1))
    return dims.resolve_tiempo(c.src.reserva.select("id_reserva", "fecha_hora"), conocidos).select("id_reserva", "tiempo_id")


@query("E13")
def _(c: Context) -> DataFrame:
    return dims.with_provincia(c.src.usuario, "latitud", "longitud", "provincia").select("id_usuario", "provincia")


@query("E14")
def _(c: Context) -> DataFrame:
    return dims.provincia_by_range(
        c.src.usuario, warehouse.seed_ubicacion(c.spark), "latitud", "longitud", "provincia"
    ).select("id_usuario", "provincia")


@query("E15")
def _(c: Context) -> DataFrame:
    """Categories of all lines against a dimension that already holds two of them."""
    existentes = c.categorias.filter(F.col("nombre_categoria").isin("Postre", "Entrada")).select(
        F.when(F.col("nombre_categoria") == "Postre", 40).otherwise(7).alias("categoria_id"), "nombre_categoria"
    )
    return dims.upsert_categorias(c.extraido.detalle, existentes)


@query("E16")
def _(c: Context) -> DataFrame:
    lineas = dims.assign_categoria(c.extraido.detalle, c.categorias)
    return dims.upsert_productos(lineas, c.productos.filter(F.col("fuente_datos") == "postgres")).select(
        "producto_id", "nombre", "categoria_id", F.col("precio_actual").cast("double").alias("precio_actual"),
        "id_menu", "activo", "fuente_datos",
    )


@query("E17")
def _(c: Context) -> DataFrame:
    cargados = c.pedidos.filter((F.col("id_pedido") % 4 != 0) | (F.col("fuente_datos") == "mongo"))
    return dims.only_new(c.extraido.pedidos, cargados, schemas.CLAVES["fact_pedidos"]).select("id_pedido", "fuente_datos")


@query("E17_incremento")
def _(c: Context) -> DataFrame:
    """A staged increment, half of it known: only the buckets of its own keys are read."""
    conocido = c.extraido.pedidos.filter("id_pedido % 97 = 0").select("id_pedido", "fuente_datos")
    lote = c.escrita("lote_pedidos", conocido.unionByName(conocido.withColumn("id_pedido", F.col("id_pedido") + 1000000000)))
    return dims.only_new_keys(lote, c.almacen.keys("fact_pedidos"), staged=True)


@query("E18")
def _(c: Context) -> DataFrame:
    return _sin_sello(load.load_fact_pedidos(c.extraido.pedidos, c.tiempo), "fact_pedidos")


@query("E19")
def _(c: Context) -> DataFrame:
    return _sin_sello(load.load_fact_reservas(c.extraido.reservas, c.tiempo), "fact_reservas")


@query("E20")
def _(c: Context) -> DataFrame:
    return _sin_sello(load.load_fact_detalle(c.extraido.detalle, c.tiempo, c.categorias), "fact_detalle_pedidos")


def _sin_sello(df: DataFrame, tabla: str) -> DataFrame:
    """A fact as it is written, without the time of the run and with decimals as double."""
    filas = warehouse.conform(df, tabla).drop("fecha_etl")
    decimales = [n for n, tipo in schemas.TABLAS[tabla].items() if tipo.startswith("DECIMAL")]
    return filas.withColumns({n: F.col(n).cast("double") for n in decimales}) if decimales else filas


@query("E21")
def _(c: Context) -> DataFrame:
    """Rows loaded per table by a first and by a second run over the same input."""
    from fogon.operators.load import run_etl

    destino = warehouse.Warehouse(c.spark, f"{c.carpeta}/etl-{uuid.uuid4().hex[:8]}")
    primera, segunda = run_etl(c.extraido, destino), run_etl(c.extraido, destino)
    tablas = None
    for t in primera:
        fila = destino.table(t).agg(F.count(F.lit(1)).alias("filas")).select(
            F.lit(t).alias("tabla"), F.lit(primera[t]).cast("bigint").alias("primera"),
            F.lit(segunda[t]).cast("bigint").alias("segunda"), "filas",
        )
        tablas = fila if tablas is None else tablas.unionAll(fila)
    return tablas


@query("E22")
def _(c: Context) -> DataFrame:
    k = F.col("id_pedido")
    solicitudes = c.src.detalle.select(
        "id_pedido", "id_detalle",
        F.when(k % 10 == 0, F.col("id_producto") + 100000000).otherwise(F.col("id_producto")).alias("id_producto"),
        F.when(k % 7 == 0, 0).otherwise(F.col("cantidad")).alias("cantidad"),
    )
    return maintenance.price_lines(solicitudes, c.src.producto)


@query("E23")
def _(c: Context) -> DataFrame:
    return maintenance.nest_orders(c.src.pedido, c.src.detalle).select(
        "id_pedido", "estado", F.size("detalles").alias("lineas"), _texto_lineas().alias("detalle")
    )


@query("E24")
def _(c: Context) -> DataFrame:
    k = F.col("id_pedido")
    cambios = c.src.pedido.filter(F.col("estado") != "entregado").select(
        "id_pedido",
        F.when(k % 2 == 0, "entregado").alias("estado"),
        F.when(k % 3 == 0, "para recoger").alias("tipo"),
        F.lit(None).cast("timestamp_ntz").alias("fecha_hora"),
        F.when(F.col("id_repartidor").isNull(), F.lit(1)).cast("bigint").alias("id_repartidor"),
    )
    return maintenance.apply_order_updates(c.src.pedido, cambios)


@query("E24_almacen")
def _(c: Context) -> DataFrame:
    """Orders changed in a written warehouse: states, types, drivers, and times that move rows to other months."""
    destino = warehouse.Warehouse(c.spark, f"{c.carpeta}/cambios-{uuid.uuid4().hex[:8]}").init()
    for tabla, df in (("dim_tiempo", c.tiempo), ("fact_pedidos", c.pedidos), ("fact_detalle_pedidos", c.detalle)):
        destino.append(df, tabla, by_month=True)
    k = F.col("id_pedido")
    cambios = c.src.pedido.filter(k % 13 == 5).select(
        "id_pedido", "fuente_datos",
        F.when(k % 2 == 0, "entregado").alias("estado"),
        F.when(k % 3 == 0, "para recoger").alias("tipo"),
        F.when(F.col("id_repartidor").isNull(), F.lit(1)).cast("bigint").alias("id_repartidor"),
        F.when(k % 4 == 1, F.col("fecha_hora") + F.expr("interval 40 days 17 minutes")).alias("fecha_hora"),
    )
    refresh.refresh_orders(destino, cambios)
    iguales = [F.col(f"d.{a}").eqNullSafe(F.col(f"p.{b}")) for a, b in (
        ("estado_pedido", "estado"), ("tipo_pedido", "tipo"), ("id_repartidor", "id_repartidor"), ("tiempo_id", "tiempo_id"),
        ("fecha_creacion", "fecha_creacion"), ("anio", "anio"), ("mes", "mes"))]
    acordes = iguales[0]
    for i in iguales[1:]:
        acordes = acordes & i
    pedidos, lineas = destino.table("fact_pedidos").alias("p"), destino.table("fact_detalle_pedidos").alias("d")
    por_pedido = pedidos.join(lineas, ["id_pedido", "fuente_datos"]).groupBy("id_pedido", "fuente_datos").agg(
        F.count(F.lit(1)).alias("lineas"), F.count_if(acordes).alias("acordes")
    )
    minutos = destino.table("dim_tiempo").select("tiempo_id", "fecha", "hora", "minuto")
    return (
        destino.table("fact_pedidos").join(por_pedido, ["id_pedido", "fuente_datos"], "left").join(minutos, "tiempo_id", "left")
        .select("id_pedido", "fuente_datos", "estado", "tipo", "id_repartidor", F.col("total_pedido").cast("double").alias("total_pedido"),
                "provincia_cliente", "fecha_creacion", "anio", "mes", "fecha", "hora", "minuto",
                F.coalesce("lineas", F.lit(0)).alias("lineas"), F.coalesce("acordes", F.lit(0)).alias("acordes"))
    )


@query("E25")
def _(c: Context) -> DataFrame:
    k = F.col("id_repartidor")
    cambios = c.src.repartidor.filter(k % 4 != 1).select(
        "id_repartidor",
        F.when(k % 2 == 0, F.lit(9.93)).alias("latitud_actual"),
        F.when(k % 2 == 0, F.lit(-84.08)).alias("longitud_actual"),
        F.when(k % 3 == 0, "desconectado").alias("estado"),
    )
    return maintenance.apply_driver_updates(c.src.repartidor, cambios)


def _purga(c: Context):
    s = c.src
    tablas = {
        "restaurante": s.restaurante, "menu": s.menu, "producto": s.producto, "reserva": s.reserva,
        "pedido": maintenance.nest_orders(s.pedido, s.detalle),
    }
    ids = s.usuario.filter(F.col("id_usuario") % 75 == 30).select("id_usuario")
    return maintenance.purge_users(tablas, ids)


@query("E26")
def _(c: Context) -> DataFrame:
    return _purga(c)[1]


@query("E26_pedidos")
def _(c: Context) -> DataFrame:
    return _purga(c)[0]["pedido"].select("id_pedido", F.size("detalles").alias("lineas"), _texto_lineas().alias("detalle"))


@query("E27")
def _(c: Context) -> DataFrame:
    """Clean-up after every 20th user, every 9th driver and every 7th menu are gone."""
    s = c.src
    tablas = {
        "usuario": s.usuario.filter(F.col("id_usuario") % 20 != 7), "restaurante": s.restaurante,
        "repartidor": s.repartidor.filter(F.col("id_repartidor") % 9 != 2), "menu": s.menu.filter(F.col("id_menu") % 7 != 3),
        "producto": s.producto, "reserva": s.reserva, "pedido": s.pedido, "detalle": s.detalle,
    }
    limpias = maintenance.enforce_fk(tablas)
    total = None
    for tabla, nulo in (("usuario", "id_referido"), ("restaurante", None), ("menu", None), ("producto", None),
                        ("reserva", None), ("pedido", "id_repartidor"), ("detalle", None)):
        nulos = F.count(F.when(F.col(nulo).isNull(), 1)) if nulo else F.lit(0).cast("bigint")
        fila = limpias[tabla].agg(F.count(F.lit(1)).alias("filas"), nulos.alias("nulos"))
        fila = fila.select(F.lit(tabla).alias("tabla"), "filas", "nulos")
        total = fila if total is None else total.unionAll(fila)
    return total


@query("E28")
def _(c: Context) -> DataFrame:
    """Rule violations in the tables, some of whose rows are spoilt first."""
    s = c.src
    tablas = {
        "usuario": s.usuario,
        "restaurante": s.restaurante.withColumn("latitud", F.when(F.col("id_restaurante") % 8 == 1, 95.0).otherwise(F.col("latitud"))),
        "repartidor": s.repartidor.withColumn("estado", F.when(F.col("id_repartidor") % 6 == 5, "perdido").otherwise(F.col("estado"))),
        "producto": s.producto.withColumn("precio", F.when(F.col("id_producto") % 50 == 9, -1.0).otherwise(F.col("precio"))),
        "reserva": s.reserva,
        "pedido": s.pedido.withColumn("tipo", F.when(F.col("id_pedido") % 31 == 0, "a domicilio").otherwise(F.col("tipo"))),
        "detalle": s.detalle.withColumn("cantidad", F.when(F.col("id_pedido") % 29 == 0, 0).otherwise(F.col("cantidad"))),
    }
    return maintenance.quality_report(tablas)


# --- Cubes, report, dashboard -------------------------------------------------------------------------

CUBOS = [
    "cubo_pedidos_tiempo", "cubo_reservas_tiempo", "cubo_pedidos_ubicacion", "cubo_actividad_zona", "cubo_matriz_od",
    "cubo_productos_tiempo", "cubo_productos_ubicacion", "cubo_top_productos_anual", "cubo_frecuencia_uso",
]
for _i, _nombre in enumerate(CUBOS, start=1):
    REGISTRO[f"C{_i:02d}"] = lambda c, n=_nombre: c.cubo(n)

REGISTRO |= {
    "C10": lambda c: cubes.metricas_desde_cubo(c.cubo("cubo_pedidos_tiempo")),
    "C11": lambda c: cubes.ranking_desde_cubo(c.cubo("cubo_actividad_zona")),
    "C12": lambda c: cubes.reservas_desde_cubo(c.cubo("cubo_reservas_tiempo")),
    "A01": lambda c: report.ventas_categoria_mes(c.detalle, c.tiempo, c.categorias),
    "A02": lambda c: report.top_productos_ingresos(c.detalle, c.tiempo, c.productos, c.categorias),
    "A03": lambda c: report.mezcla_tipo_pedido(c.pedidos, c.tiempo),
    "A04": lambda c: report.crecimiento_categoria(c.detalle, c.tiempo, c.categorias),
    "A05": lambda c: report.actividad_dia_semana(c.pedidos, c.tiempo),
    "A06": lambda c: report.finde_vs_laboral(c.pedidos, c.tiempo),
    "A07": lambda c: report.actividad_provincia_tipodia(c.pedidos, c.tiempo),
    "A08": lambda c: report.eficiencia_estados(c.pedidos, c.tiempo),
    "A09": lambda c: report.crecimiento_mensual(c.pedidos, c.tiempo),
    "A10": lambda c: report.expansion_geografica(c.pedidos, c.tiempo),
    "A11": lambda c: report.flujos_interprovinciales(c.pedidos, c.tiempo),
    "A12": lambda c: report.crecimiento_trimestral(c.pedidos, c.tiempo),
    "A13": lambda c: report.resumen_general(c.pedidos, c.tiempo),
    "A14": lambda c: report.ranking_provincias(c.pedidos),
    "A15": lambda c: report.resumen_reservas(c.reservas),
}


def _kpis(c: Context, fuente: str = "Todos") -> DataFrame:
    return dashboard.kpis(c.pedidos, c.tiempo, fuente)


def _tendencia(c: Context, grano: str, fuente: str = "Todos") -> DataFrame:
    return dashboard.tendencia(c.pedidos, c.tiempo, fuente, grano)


def _top20(c: Context, fuente: str = "Todos") -> DataFrame:
    return dashboard.top_productos(c.detalle, c.productos, c.categorias, fuente)


def _top15(c: Context) -> DataFrame:
    return dashboard.reordenar(_top20(c), "unidades_vendidas", 15)


def _dias(c: Context) -> DataFrame:
    return dashboard.por_dia_semana(c.pedidos, c.tiempo)


def _horas(c: Context) -> DataFrame:
    return dashboard.por_hora(c.pedidos, c.tiempo)


def _pico(c: Context) -> DataFrame:
    return dashboard.pico_vs_normal(c.pedidos, c.tiempo)


def _flujos(c: Context) -> DataFrame:
    return dashboard.flujos(c.pedidos)


def _categorias(c: Context) -> DataFrame:
    return dashboard.analisis_categorias(c.detalle, c.categorias)


def _precios(c: Context) -> DataFrame:
    return dashboard.analisis_precios(c.detalle, c.categorias)


REGISTRO |= {
    "D01": lambda c: dashboard.filter_source(c.reservas, "MongoDB").select("id_reserva", "estado", "fuente_datos"),
    "D02": lambda c: _kpis(c),
    "D02_mongo": lambda c: _kpis(c, "MongoDB"),
    "D03": lambda c: dashboard.kpis_derivados(_kpis(c)),
    "D04": lambda c: _tendencia(c, "dia"),
    "D05": lambda c: _tendencia(c, "mes"),
    "D06": lambda c: _tendencia(c, "trimestre"),
    "D06_postgres": lambda c: _tendencia(c, "trimestre", "PostgreSQL"),
    "D07": lambda c: dashboard.resumen_tendencia(_tendencia(c, "mes")),
    "D08": lambda c: dashboard.estadisticas_tendencia(_tendencia(c, "mes")),
    "D09": lambda c: dashboard.crecimiento_promedio(_tendencia(c, "mes")),
    "D10": lambda c: dashboard.geo_restaurantes(c.pedidos),
    "D11": lambda c: dashboard.geo_clientes(c.pedidos),
    "D12": lambda c: dashboard.locales_vs_externos(dashboard.geo_clientes(c.pedidos)),
    "D13": lambda c: _flujos(c),
    "D14": lambda c: dashboard.matriz_flujos(_flujos(c)),
    "D15": lambda c: dashboard.top_flujos(_flujos(c)),
    "D16": lambda c: dashboard.resumen_geo(dashboard.geo_restaurantes(c.pedidos), dashboard.geo_clientes(c.pedidos), _flujos(c)),
    "D17": lambda c: _categorias(c),
    "D18": lambda c: _top20(c),
    "D19": lambda c: _top15(c),
    "D20": lambda c: dashboard.distribucion_top(_top15(c)),
    "D21": lambda c: _precios(c),
    "D22": lambda c: dashboard.resumen_productos(_categorias(c), _top20(c), _precios(c)),
    "D23": lambda c: _dias(c),
    "D24": lambda c: dashboard.resumen_finde(_dias(c)),
    "D25": lambda c: _horas(c),
    "D26": lambda c: dashboard.por_periodo_dia(_horas(c)),
    "D27": lambda c: dashboard.top_horas(_horas(c)),
    "D28": lambda c: _pico(c),
    "D29": lambda c: dashboard.participacion_pico(_pico(c)),
    "D30": lambda c: dashboard.detalle_horas_pico(c.pedidos, c.tiempo),
    "D30_lista": lambda c: dashboard.lista_horas_pico(dashboard.detalle_horas_pico(c.pedidos, c.tiempo)),
    "D31": lambda c: dashboard.resumen_horarios(_dias(c), _horas(c), _pico(c)),
}

# --- Graph --------------------------------------------------------------------------------------------


def _merge(c: Context, label: str) -> DataFrame:
    """Node table after a third of its rows is written again, some of them twice, and new ones are added."""
    base = c.nodos[label]
    clave = nodes.CLAVES_NODO[label]
    campo = "estado" if label == "Pedido" else "nombre"
    viejos = base.filter(F.col(clave) % 5 != 0).withColumn("updated_at", F.lit(10))
    cambios = base.filter(F.col(clave) % 3 == 0).select("*", F.explode(F.array(F.lit(5), F.lit(20), F.lit(30))).alias("updated_at"))
    cambios = cambios.filter((F.col("updated_at") != 30) | (F.col(clave) % 2 == 0)).withColumn(
        campo, F.concat_ws("#", F.col(campo), F.col("updated_at").cast("string"))
    )
    return nodes.merge_nodes(label, cambios, viejos)


for _i, _nombre in enumerate(("Restaurante", "Repartidor", "Usuario", "Pedido", "Producto"), start=1):
    REGISTRO[f"G{_i:02d}"] = lambda c, n=_nombre: _merge(c, n)


def _redondo(df: DataFrame, *columnas: str, digitos: int = 4) -> DataFrame:
    """Distances without the last bits, in which math libraries differ."""
    return df.withColumns({x: F.round(x, digitos) for x in columnas})


def _top_conductores(c: Context) -> DataFrame:
    return delivery.top_drivers(c.nodos["Repartidor"], c.asignado)


def _cercanos(c: Context, k: int) -> DataFrame:
    vecinos = delivery.k_nearest_drivers(c.src.en_fuentes("restaurante"), c.src.en_fuentes("repartidor"), k)
    return _redondo(vecinos, "distancia_km").drop("fecha_calculo")


def _top_restaurantes(c: Context) -> DataFrame:
    return delivery.top_restaurants(c.nodos["Restaurante"], c.proviene)


def _metricas_entrega(c: Context) -> DataFrame:
    return delivery.delivery_metrics(c.nodos, c.asignado, c.proviene)


def _eficiencia(c: Context) -> DataFrame:
    return delivery.driver_efficiency(c.nodos["Repartidor"], c.asignado, c.entrega)


def _recomendadas(c: Context) -> DataFrame:
    return copurchase.recommend(c.comprado_con, c.nodos["Producto"], "gear", 15)


def _metricas_compras(c: Context) -> DataFrame:
    return copurchase.copurchase_metrics(c.comprado_con, c.nodos["Producto"])


REGISTRO |= {
    "G06": lambda c: c.contiene,
    "G07": lambda c: c.proviene,
    "G08": lambda c: c.pertenece,
    "G09": lambda c: c.asignado,
    "G10": lambda c: c.refiere,
    "G11": lambda c: c.comprado_con,
    "G12": lambda c: copurchase.top_copurchase_pairs(c.comprado_con, c.nodos["Producto"], "postgres"),
    "G13": lambda c: influence.top_influencers(c.nodos["Usuario"], c.refiere, "postgres"),
    "G14": lambda c: delivery.nearest_driver(c.distancias),
    "G15": lambda c: _redondo(c.entrega, "distancia_km"),
    "G16_cercanas": lambda c: _redondo(delivery.nearest_stops(c.paradas, 3), "distancia_km"),
    "G16": lambda c: _redondo(delivery.stop_matrix(c.paradas), "distancia_km"),
    "G17": lambda c: routing.routes(c.paradas),
    "G18": lambda c: delivery.assign_drivers(
        c.src.pedido.withColumnRenamed("fuente_datos", "source_db"), c.src.en_fuentes("restaurante"), c.src.en_fuentes("repartidor")
    ),
    "G19": lambda c: nodes.sync_counts(c.nodos["Producto"], c.nodos["Pedido"], c._lineas_grafo()),
    "G20": lambda c: copurchase.pair_labels(copurchase.top_copurchases(c.comprado_con, c.nodos["Producto"])),
    "G21": lambda c: _metricas_compras(c),
    "G22": lambda c: copurchase.strong_relations(c.comprado_con, c.nodos["Producto"]),
    "G23": lambda c: _recomendadas(c),
    "G24": lambda c: copurchase.recommend_summary(_recomendadas(c)),
    "G24_lista": lambda c: copurchase.product_pick_list(copurchase.top_copurchases(c.comprado_con, c.nodos["Producto"], None, 100)),
    "G25": lambda c: copurchase.copurchase_coverage(_metricas_compras(c)),
    "G26": lambda c: influence.influence_network(c.nodos["Usuario"], c.refiere, None, None),
    "G27": lambda c: influence.influence_metrics(c.nodos["Usuario"], c.refiere),
    "G28": lambda c: influence.influence_distribution(c.nodos["Usuario"], c.refiere, None),
    "G28_postgres": lambda c: influence.influence_distribution(c.nodos["Usuario"], c.refiere, ["postgres"]),
    "G29": lambda c: influence.engagement(influence.influence_metrics(c.nodos["Usuario"], c.refiere)),
    "G30": lambda c: _top_conductores(c),
    "G31": lambda c: delivery.driver_activity(delivery.top_drivers(c.nodos["Repartidor"], c.asignado, limit=None)),
    "G32": lambda c: _top_restaurantes(c),
    "G33": lambda c: delivery.restaurant_distribution(_top_restaurantes(c)),
    "G34": lambda c: _metricas_entrega(c),
    "G35": lambda c: delivery.delivery_rates(_metricas_entrega(c)),
    "G36": lambda c: _redondo(_eficiencia(c), "distancia_promedio_km", "distancia_minima_km", "distancia_maxima_km"),
    "G37": lambda c: delivery.efficiency_ranking(_eficiencia(c)),
    "G38": lambda c: copurchase.combos_by_price(c.comprado_con, c.nodos["Producto"]),
    "G39": lambda c: influence.influencers_by_zone(c.nodos["Usuario"], c.refiere, "postgres"),
    "G40": lambda c: _cercanos(c, 5),
    "G40_k10": lambda c: _cercanos(c, 10),
    "G41": lambda c: delivery.delivery_chains(c.proviene, c.asignado, c.pertenece),
    "G42": lambda c: copurchase.copurchase_network(c.comprado_con, 2),
    "G43": lambda c: influence.referral_network(c.nodos["Usuario"], c.refiere),
    "G44": lambda c: delivery.restaurant_subgraph(c.nodos["Restaurante"], c.proviene, c.contiene, c.pertenece, c.asignado),
    "G45": lambda c: nodes.all_edges(c.aristas()),
    "G46": lambda c: nodes.node_counts(c.nodos),
}

# --- Search and operational reads ---------------------------------------------------------------------


def _cambios(c: Context) -> DataFrame:
    k = F.col("id_producto")
    base = search.build_search_index(c.src.producto).select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"))
    nuevos = base.filter((k % 4 == 0) | ((k % 6 == 1) & (F.col("seq") == 2)))
    return nuevos.select(
        F.when((k % 8 == 0) & (F.col("seq") == 2), "delete").otherwise("upsert").alias("op"), "seq",
        F.when(k % 12 == 1, k + 50000000).otherwise(k).alias("id_producto"),
        F.concat(F.col("nombre"), F.lit(" v"), F.col("seq").cast("string")).alias("nombre"),
        "categoria", F.when(F.col("seq") == 2, "").otherwise(F.col("descripcion")).alias("descripcion"), "precio", "id_menu",
    )


def _cambiado(c: Context) -> SearchIndex:
    """An index that was changed and is not built anew."""
    buscador = SearchIndex(c.spark, f"{c.carpeta}/buscador-{uuid.uuid4().hex[:8]}").create(c.indice)
    return buscador.apply(_cambios(c))


REGISTRO |= {
    "T01": lambda c: c.indice,
    "T01_tokens": lambda c: c.tokens,
    "T02": lambda c: search.search_scores(c.tokens, "smal wigdet brand#2"),
    "T02_pagina": lambda c: search.search(c.indice, c.tokens, "smal wigdet", 2, 10),
    "T03": lambda c: search.search_category(c.indice, "Postre", 1, 20),
    "T04": lambda c: c.usuarios_listados.page(3, 25),
    "T04_ultima": lambda c: c.usuarios_listados.page(6, 25),
    "T04_categoria": lambda c: c.productos_listados.page(2, 5, "Postre"),
    "T02_listado": lambda c: c.indice.join(c.hallados_listados.page(2, 10), "id_producto"),
    "T02_indice": lambda c: c.buscador.search_scores("smal wigdet brand#2"),
    "T05_busqueda": lambda c: _cambiado(c).search_scores("smal wigdet v2 brand#2"),
    "T05_productos": lambda c: _cambiado(c).products(),
    "T05": lambda c: search.apply_index_changes(c.indice, _cambios(c)),
    "O01": lambda c: operations.open_orders_by_driver(c.src.pedido, c.src.detalle).select(
        "id_repartidor", "id_pedido", "fecha_hora", "estado", _texto_lineas().alias("detalle")
    ),
    "O02": lambda c: operations.unassigned_orders(c.src.pedido),
    "O03": lambda c: operations.available_drivers(c.src.repartidor),
    "O04": lambda c: operations.available_with_location(c.src.repartidor),
    "O05": lambda c: operations.users_by_driver(c.src.pedido, c.src.usuario),
    "O06": lambda c: operations.users_with_location(c.src.usuario),
    "O07": lambda c: operations.users_with_referrer(c.src.usuario),
    "O08": lambda c: operations.restaurants_with_location(c.src.restaurante),
    "O09": lambda c: operations.list_entity(c.src.usuario, [F.desc("fecha_registro"), "id_usuario"]),
    "O09_reservas": lambda c: operations.list_entity(c.src.reserva, ["id_reserva"]),
}
