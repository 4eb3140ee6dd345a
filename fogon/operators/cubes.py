"""OLAP cubes over the warehouse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fogon.functions.geo import SIN_UBICACION
from fogon.functions.measures import ESTADOS, TIPOS, conteos, doble, o_cero, pct, por_tiempo, razon, uno_si
from fogon.functions.ordered import rank_desc

DIA = ["fecha", "anio", "mes", "trimestre", "dia_semana", "es_fin_semana"]
MES = ["anio", "mes"]


def local() -> Column:
    return F.col("provincia_cliente") == F.col("provincia_restaurante")


def externo() -> Column:
    return F.col("provincia_cliente") != F.col("provincia_restaurante")


def fuentes(prefijo: str) -> dict[str, Column]:
    return conteos("fuente_datos", {f"{prefijo}_postgres": "postgres", f"{prefijo}_mongo": "mongo"})


def tipo_flujo() -> Column:
    sin_info = (F.col("provincia_cliente") == SIN_UBICACION) | (F.col("provincia_restaurante") == SIN_UBICACION)
    return F.when(local(), "Local").when(sin_info, "Sin Info").otherwise("Inter-Provincial")


def _dias(dim_tiempo: DataFrame, por_dia: DataFrame) -> DataFrame:
    """Every day of the dimension, with its measures or none; one row per day on both sides."""
    return dim_tiempo.select(*DIA).distinct().join(por_dia, DIA, "left")


def _entero(*nombres: str) -> list[Column]:
    return [F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in nombres]


def _pedidos() -> dict[str, Column]:
    """Additive measures of an order row."""
    return {
        "n": F.lit(1), "monto": F.col("total_pedido"), "items": F.col("cantidad_items"),
        **conteos("estado", ESTADOS), **conteos("tipo", TIPOS),
    }


def cubo_pedidos_tiempo(dim_tiempo: DataFrame, fact_pedidos: DataFrame) -> DataFrame:
    sumas = {**_pedidos(), "n": uno_si(F.col("id_pedido").isNotNull()), **fuentes("pedidos")}
    por_dia = por_tiempo(fact_pedidos, [], DIA, sumas)
    return _dias(dim_tiempo, por_dia).select(
        *DIA,
        F.coalesce("n", F.lit(0)).cast("bigint").alias("total_pedidos"),
        o_cero(doble("monto")).alias("ingresos_totales"),
        o_cero(razon("monto", "n")).alias("ticket_promedio"),
        F.coalesce("items", F.lit(0)).cast("bigint").alias("items_vendidos"),
        *_entero(*ESTADOS, *TIPOS, *fuentes("pedidos")),
    )


def cubo_reservas_tiempo(dim_tiempo: DataFrame, fact_reservas: DataFrame) -> DataFrame:
    estados = conteos("estado", {"reservas_confirmadas": "confirmada", "reservas_pendientes": "pendiente",
                                 "reservas_canceladas": "cancelada"})
    sumas = {"n": uno_si(F.col("id_reserva").isNotNull()), **estados, **fuentes("reservas")}
    por_dia = por_tiempo(fact_reservas, [], DIA, sumas)
    return _dias(dim_tiempo, por_dia).select(
        *DIA,
        F.coalesce("n", F.lit(0)).cast("bigint").alias("total_reservas"),
        *_entero(*estados),
        o_cero(pct("reservas_confirmadas", "n")).alias("tasa_confirmacion_pct"),
        *_entero(*fuentes("reservas")),
    )


def cubo_pedidos_ubicacion(fact_pedidos: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    llaves = ["provincia_cliente", "provincia_restaurante"]
    sumas = {**_pedidos(), "pedidos_misma_provincia": uno_si(local()), "pedidos_inter_provincia": uno_si(externo()),
             **fuentes("pedidos")}
    distintos = {"usuarios_unicos": F.col("id_usuario"), "restaurantes_unicos": F.col("id_restaurante")}
    cubo = por_tiempo(fact_pedidos.dropna(subset=llaves), llaves, [*MES, "trimestre"], sumas, distintos)
    return cubo.select(
        *llaves, *MES, "trimestre",
        F.col("n").alias("total_pedidos"),
        o_cero(doble("monto")).alias("ingresos_totales"),
        o_cero(razon("monto", "n")).alias("ticket_promedio"),
        *_entero("items"), "pedidos_misma_provincia", "pedidos_inter_provincia",
        pct("pedidos_misma_provincia", "n").alias("porcentaje_pedidos_locales"),
        *ESTADOS, *TIPOS, *fuentes("pedidos"), *distintos,
    ).withColumnRenamed("items", "items_vendidos")


def cubo_actividad_zona(fact_pedidos: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    distintos = {"restaurantes_activos": F.col("id_restaurante"), "repartidores_activos": F.col("id_repartidor"),
                 "usuarios_activos": F.col("id_usuario"), "provincias_origen_clientes": F.col("provincia_cliente")}
    sumas = {**_pedidos(), "externos": uno_si(externo()), **fuentes("transacciones")}
    con_zona = fact_pedidos.filter(F.col("provincia_restaurante") != SIN_UBICACION)
    cubo = por_tiempo(con_zona, ["provincia_restaurante"], [*MES, "trimestre"], sumas, distintos)
    return cubo.select(
        F.col("provincia_restaurante").alias("provincia"), *MES, "trimestre", *distintos,
        F.col("n").alias("total_transacciones"),
        o_cero(doble("monto")).alias("volumen_negocio"),
        o_cero(razon("monto", "n")).alias("ticket_promedio_zona"),
        F.coalesce("items", F.lit(0)).cast("bigint").alias("items_vendidos"),
        F.col("externos").alias("pedidos_recibidos_otras_provincias"),
        pct("externos", "n").alias("porcentaje_clientes_externos"),
        F.col("pedidos_entregados").alias("pedidos_completados"),
        pct("pedidos_entregados", "n").alias("tasa_completitud_pct"),
        *fuentes("transacciones"),
    )


def cubo_matriz_od(fact_pedidos: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    llaves = ["provincia_cliente", "provincia_restaurante"]
    distintos = {"usuarios_unicos": F.col("id_usuario"), "restaurantes_unicos": F.col("id_restaurante")}
    sumas = {"n": F.lit(1), "monto": F.col("total_pedido"), **fuentes("pedidos")}
    cubo = por_tiempo(fact_pedidos.dropna(subset=llaves), llaves, MES, sumas, distintos)
    return cubo.select(
        F.col("provincia_cliente").alias("origen"), F.col("provincia_restaurante").alias("destino"), *MES,
        F.col("n").alias("total_pedidos"),
        o_cero(doble("monto")).alias("valor_flujo"),
        o_cero(razon("monto", "n")).alias("ticket_promedio"),
        *distintos, tipo_flujo().alias("tipo_flujo"), *fuentes("pedidos"),
    )


# Categories with a column of their own.
VENTAS_CATEGORIA = {"ventas_bebidas": "Bebida", "ventas_platos_principales": "Plato principal",
                    "ventas_postres": "Postre", "ventas_entradas": "Entrada"}


def cubo_productos_tiempo(dim_tiempo: DataFrame, fact_detalle: DataFrame, dim_categorias: DataFrame) -> DataFrame:
    lineas = fact_detalle.join(dim_categorias, "categoria_id", "left")
    sumas = {
        "n": uno_si(F.col("id_producto").isNotNull()),
        "monto": F.col("subtotal"), "unidades": F.col("cantidad"),
        "precios": F.col("precio_unitario"), "n_precios": uno_si(F.col("precio_unitario").isNotNull()),
        **conteos("nombre_categoria", VENTAS_CATEGORIA),
        **conteos("estado_pedido", {"productos_entregados": "entregado", "productos_pendientes": "pendiente"}),
        **fuentes("productos"),
    }
    por_dia = por_tiempo(lineas, [], DIA, sumas, {"productos_unicos": F.col("id_producto")})
    return _dias(dim_tiempo, por_dia).select(
        *DIA,
        F.coalesce("n", F.lit(0)).cast("bigint").alias("total_productos_vendidos"),
        *_entero("productos_unicos"),
        o_cero(doble("monto")).alias("ingresos_productos"),
        F.coalesce("unidades", F.lit(0)).cast("bigint").alias("unidades_vendidas"),
        o_cero(razon("precios", "n_precios")).alias("precio_promedio"),
        *_entero(*VENTAS_CATEGORIA, "productos_entregados", "productos_pendientes", *fuentes("productos")),
    )


def medidas_linea() -> dict[str, Column]:
    """Additive measures of an order line."""
    return {"n": F.lit(1), "monto": F.col("subtotal"), "unidades": F.col("cantidad"), "precios": F.col("precio_unitario"),
            "n_precios": uno_si(F.col("precio_unitario").isNotNull())}


def cubo_productos_ubicacion(fact_detalle: DataFrame, dim_tiempo: DataFrame, dim_categorias: DataFrame) -> DataFrame:
    provincias = ["provincia_cliente", "provincia_restaurante"]
    lineas = fact_detalle.dropna(subset=provincias).join(dim_categorias, "categoria_id")
    distintos = {"productos_unicos": F.col("id_producto"), "restaurantes_vendedores": F.col("id_restaurante"),
                 "usuarios_compradores": F.col("id_usuario")}
    sumas = {**medidas_linea(), "locales": uno_si(local()), **fuentes("ventas")}
    cubo = por_tiempo(lineas, [*provincias, "nombre_categoria"], [*MES, "trimestre"], sumas, distintos)
    return cubo.select(
        *provincias, "nombre_categoria", *MES, "trimestre",
        F.col("n").alias("total_ventas"),
        o_cero(doble("monto")).alias("ingresos_categoria"),
        F.coalesce("unidades", F.lit(0)).cast("bigint").alias("unidades_vendidas"),
        o_cero(razon("precios", "n_precios")).alias("precio_promedio"),
        *distintos, pct("locales", "n").alias("porcentaje_ventas_locales"), *fuentes("ventas"),
    )


def con_producto(lineas: DataFrame, dim_productos: DataFrame, dim_categorias: DataFrame) -> DataFrame:
    """Lines (or sums of lines) with product and category names; the product key includes the source."""
    productos = dim_productos.select(F.col("producto_id").alias("id_producto"), "fuente_datos", "nombre")
    return lineas.join(productos, ["id_producto", "fuente_datos"]).join(dim_categorias, "categoria_id")


CLAVE_PRODUCTO = ["id_producto", "fuente_datos", "categoria_id"]


def cubo_top_productos_anual(
    fact_detalle: DataFrame, dim_tiempo: DataFrame, dim_productos: DataFrame, dim_categorias: DataFrame
) -> DataFrame:
    """Lines are summed by product before the dimension joins, which then see one row per product and year."""
    por_producto = por_tiempo(fact_detalle, CLAVE_PRODUCTO, ["anio"], medidas_linea())
    llaves = ["id_producto", "nombre", "nombre_categoria", "anio"]
    ventas = (
        con_producto(por_producto, dim_productos, dim_categorias)
        .groupBy(*llaves)
        .agg(F.sum("n").alias("total_ventas"), F.sum("monto").alias("monto"), F.sum("unidades").alias("unidades_vendidas"))
    )
    return rank_desc(ventas, ["anio"], "monto", "ranking_ingresos").select(
        F.col("id_producto").alias("producto_id"), F.col("nombre").alias("nombre_producto"), "nombre_categoria", "anio",
        "total_ventas", doble("monto").alias("ingresos_totales"), "unidades_vendidas", "ranking_ingresos",
    )


# Lines of a user that one task may group and rank; users with more are ranked by buckets.
LINEAS_POR_USUARIO = 1_000_000


def cubo_frecuencia_uso(
    fact_detalle: DataFrame, dim_productos: DataFrame, dim_categorias: DataFrame, limite: int = LINEAS_POR_USUARIO
) -> DataFrame:
    """Purchases per user and product.

    Users rarely repeat a product, so lines are neither summed ahead of the product join nor ahead of the shuffle by user, which takes
    the plain lines with the names of product and category. One shuffle serves the sums and the ranks of a user. A user with more than ``limite``
    lines would be too much for one task: the sums of such users are shuffled by user and product, and ranked by buckets.
    """
    productos = dim_productos.select(F.col("producto_id").alias("id_producto"), "fuente_datos", "nombre")
    lineas = fact_detalle.select("id_usuario", *CLAVE_PRODUCTO, "cantidad", "subtotal", "fecha_creacion")
    grandes = F.broadcast(
        fact_detalle.groupBy(F.col("id_usuario").alias("_usuario")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limite).select("_usuario")
    )
    de_grandes = F.col("id_usuario").eqNullSafe(F.col("_usuario"))
    llaves = ["id_usuario", "id_producto", "nombre", "nombre_categoria"]

    def uso(filas: DataFrame) -> DataFrame:
        return filas.groupBy(*llaves).agg(
            F.count(F.lit(1)).alias("veces_comprado"), F.sum("cantidad").alias("unidades_totales"),
            F.sum("subtotal").alias("monto"), F.count("subtotal").alias("n_montos"),
            F.min("fecha_creacion").alias("primera_compra"), F.max("fecha_creacion").alias("ultima_compra"),
        )

    def con_nombres(filas: DataFrame) -> DataFrame:
        return filas.join(productos, ["id_producto", "fuente_datos"]).join(dim_categorias, "categoria_id").drop("fuente_datos", "categoria_id")

    de_un_usuario = Window.partitionBy("id_usuario").orderBy(F.desc("veces_comprado"))
    demas = uso(con_nombres(lineas.join(grandes, de_grandes, "left_anti")).repartition("id_usuario"))
    demas = demas.withColumn("ranking_preferencia_usuario", F.rank().over(de_un_usuario).cast("long"))
    muchas = rank_desc(uso(con_nombres(lineas.join(grandes, de_grandes, "left_semi"))), ["id_usuario"], "veces_comprado", "ranking_preferencia_usuario")
    return demas.unionByName(muchas).select(
        "id_usuario", F.col("id_producto").alias("producto_id"), F.col("nombre").alias("producto"), "nombre_categoria",
        "veces_comprado", "unidades_totales",
        razon("monto", "n_montos").alias("gasto_promedio_por_compra"), doble("monto").alias("gasto_total_producto"),
        "primera_compra", "ultima_compra", "ranking_preferencia_usuario",
    )


def metricas_desde_cubo(cubo_pedidos: DataFrame) -> DataFrame:
    """General metrics out of the daily order cube; the mean ticket is the mean of the daily means."""
    con_pedidos = cubo_pedidos.filter("total_pedidos > 0")
    return con_pedidos.agg(
        F.count_distinct("fecha").alias("dias_con_datos"),
        F.sum("total_pedidos").alias("pedidos_totales"),
        F.round(F.sum("ingresos_totales"), 2).alias("ingresos_totales"),
        F.round(F.avg("ticket_promedio"), 2).alias("ticket_promedio_general"),
        F.sum("items_vendidos").alias("items_totales"),
        F.sum("pedidos_entregados").alias("pedidos_completados"),
        pct(F.sum("pedidos_entregados"), F.sum("total_pedidos")).alias("tasa_completitud_global"),
    )


def ranking_desde_cubo(cubo_zona: DataFrame) -> DataFrame:
    """Provinces by business volume out of the zone cube (sums of monthly distincts, means of monthly rates)."""
    return (
        cubo_zona.filter(F.col("provincia") != SIN_UBICACION)
        .groupBy("provincia")
        .agg(
            F.sum("total_transacciones").alias("transacciones_totales"),
            F.round(F.sum("volumen_negocio"), 2).alias("volumen_total"),
            F.sum("restaurantes_activos").alias("restaurantes_activos"),
            F.sum("usuarios_activos").alias("usuarios_activos"),
            F.round(F.avg("ticket_promedio_zona"), 2).alias("ticket_promedio"),
            F.round(F.avg("tasa_completitud_pct"), 2).alias("tasa_completitud_promedio"),
        )
        .orderBy(F.desc("volumen_total"), "provincia")
    )


def reservas_desde_cubo(cubo_reservas: DataFrame) -> DataFrame:
    return cubo_reservas.filter("total_reservas > 0").agg(
        F.sum("total_reservas").alias("reservas_totales"),
        F.sum("reservas_confirmadas").alias("confirmadas"),
        F.sum("reservas_pendientes").alias("pendientes"),
        F.sum("reservas_canceladas").alias("canceladas"),
        F.round(F.avg("tasa_confirmacion_pct"), 2).alias("tasa_confirmacion_promedio"),
    )
