"""The analysis report: consumption trends, busy periods, monthly growth and the executive summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fogon.functions import calendar as cal
from fogon.functions.geo import SIN_UBICACION
from fogon.functions.measures import ESTADOS, TIPOS, conteos, crecimiento, doble, pct, por_tiempo, razon, uno_si
from fogon.operators.cubes import CLAVE_PRODUCTO, con_producto, medidas_linea, tipo_flujo

def sumas() -> dict[str, Column]:
    """Additive measures of an order row."""
    return {
        "n": uno_si(F.col("id_pedido").isNotNull()),
        "filas": F.lit(1),
        "monto": F.col("total_pedido"),
        "n_montos": uno_si(F.col("total_pedido").isNotNull()),
        "items": F.col("cantidad_items"),
        **conteos("estado", ESTADOS),
    }


def ingresos() -> Column:
    return doble("monto")


def ticket() -> Column:
    return razon("monto", "n_montos")


def entrega() -> Column:
    return pct("pedidos_entregados", "n")



def _con_fuente(col: str) -> Column:
    """Id qualified by its source, NULL when the id is NULL."""
    return F.concat(F.col(col).cast("string"), F.lit("_"), F.col("fuente_datos"))


def _tipo_dia(laboral: str) -> Column:
    return F.when(F.col("es_fin_semana"), "Fin de Semana").otherwise(laboral)


def _previo(df: DataFrame, orden: list[str], grupo: list[str] | None = None, **columnas: str) -> DataFrame:
    """Value of the previous period. Only for rows already aggregated to periods, which are few."""
    ventana = Window.partitionBy(*(grupo or [])).orderBy(*orden)
    return df.withColumns({nueva: F.lag(col).over(ventana) for nueva, col in columnas.items()})


def ventas_categoria_mes(fact_detalle: DataFrame, dim_tiempo: DataFrame, dim_categorias: DataFrame) -> DataFrame:
    por_mes = por_tiempo(fact_detalle, ["categoria_id"], ["anio", "mes"], medidas_linea())
    return (
        por_mes.join(dim_categorias.dropna(subset=["nombre_categoria"]), "categoria_id")
        .groupBy("nombre_categoria", "anio", "mes")
        .agg(*[F.sum(c).alias(c) for c in medidas_linea()])
        .select(
            "nombre_categoria", "anio", "mes", F.col("n").alias("total_ventas"), ingresos().alias("ingresos_categoria"),
            F.col("unidades").alias("unidades_vendidas"), razon("precios", "n_precios").alias("precio_promedio"),
        )
        .orderBy(F.desc("anio"), F.desc("mes"), F.desc("total_ventas"), "nombre_categoria")
    )


def top_productos_ingresos(
    fact_detalle: DataFrame, dim_tiempo: DataFrame, dim_productos: DataFrame, dim_categorias: DataFrame, n: int = 10
) -> DataFrame:
    por_producto = por_tiempo(fact_detalle, CLAVE_PRODUCTO, ["anio"], medidas_linea())
    return (
        con_producto(por_producto, dim_productos, dim_categorias)
        .groupBy("anio", F.col("nombre").alias("nombre_producto"), "nombre_categoria")
        .agg(F.sum("n").alias("total_ventas"), doble(F.sum("monto")).alias("ingresos_totales"),
             F.sum("unidades").alias("unidades_vendidas"))
        .orderBy(F.desc("anio"), F.desc("ingresos_totales"), "nombre_producto", "nombre_categoria")
        .limit(n)
    )


def mezcla_tipo_pedido(fact_pedidos: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    return (
        por_tiempo(fact_pedidos, [], ["mes", "anio"], {**sumas(), **conteos("tipo", TIPOS)})
        .select(
            "mes", "anio", *TIPOS, F.col("filas").alias("total_pedidos"),
            pct("pedidos_restaurante", "filas").alias("pct_restaurante"),
            pct("pedidos_recoger", "filas").alias("pct_recoger"), ticket().alias("ticket_promedio"),
        )
        .orderBy(F.desc("anio"), F.desc("mes"))
    )


def crecimiento_categoria(fact_detalle: DataFrame, dim_tiempo: DataFrame, dim_categorias: DataFrame) -> DataFrame:
    anual = (
        por_tiempo(fact_detalle, ["categoria_id"], ["anio"], medidas_linea())
        .join(dim_categorias.dropna(subset=["nombre_categoria"]), "categoria_id")
        .groupBy("nombre_categoria", "anio")
        .agg(F.sum("n").alias("ventas_anuales"), doble(F.sum("monto")).alias("ingresos_anuales"))
    )
    return (
        _previo(anual, ["anio"], ["nombre_categoria"], ventas_ano_anterior="ventas_anuales")
        .withColumn("crecimiento_ventas_pct", crecimiento("ventas_anuales", "ventas_ano_anterior"))
        .orderBy("nombre_categoria", "anio")
    )


def actividad_dia_semana(fact_pedidos: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    """Days of the week with at least one order, so the outer join of the time dimension is not needed."""
    return (
        por_tiempo(fact_pedidos, [], ["dia_semana", "es_fin_semana"], sumas())
        .filter("n > 0")
        .select(
            "dia_semana", F.coalesce(cal.nombre_dia(F.col("dia_semana")), F.lit("Desconocido")).alias("nombre_dia"),
            "es_fin_semana", F.col("n").alias("pedidos_totales"), ingresos().alias("ingresos_totales"),
            ticket().alias("ticket_promedio"),
        )
        .orderBy("dia_semana")
    )


def finde_vs_laboral(fact_pedidos: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    return (
        por_tiempo(fact_pedidos.filter(F.col("id_pedido").isNotNull()), [], ["es_fin_semana"], sumas(),
                   distintos_tiempo={"dias_analizados": "fecha"})
        .orderBy("es_fin_semana")
        .select(
            _tipo_dia("Días Laborables").alias("tipo_dia"), "dias_analizados", F.col("n").alias("pedidos_totales"),
            F.round(razon("n", "dias_analizados"), 2).alias("promedio_pedidos_por_dia"),
            ingresos().alias("ingresos_totales"), ticket().alias("ticket_promedio"), F.col("items").alias("items_totales"),
        )
    )


def actividad_provincia_tipodia(fact_pedidos: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    return (
        por_tiempo(_con_provincia(fact_pedidos), ["provincia_restaurante"], ["es_fin_semana"], sumas(),
                   distintos_tiempo={"dias_con_actividad": "fecha"})
        .orderBy("provincia_restaurante", "es_fin_semana")
        .select(
            F.col("provincia_restaurante").alias("provincia"), _tipo_dia("Laborables").alias("tipo_dia"),
            F.col("n").alias("pedidos_totales"), ingresos().alias("ingresos_totales"), "dias_con_actividad",
        )
    )


def eficiencia_estados(fact_pedidos: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    return (
        por_tiempo(fact_pedidos, [], ["es_fin_semana"], sumas())
        .orderBy("es_fin_semana")
        .select(
            _tipo_dia("Laborables").alias("tipo_dia"), F.col("pedidos_entregados").alias("entregados"),
            F.col("pedidos_pendientes").alias("pendientes"), F.col("pedidos_preparacion").alias("en_preparacion"),
            F.col("pedidos_listos").alias("listos"), F.col("n").alias("total"), entrega().alias("tasa_entrega_pct"),
            pct("pedidos_pendientes", "n").alias("tasa_pendientes_pct"),
        )
    )


def crecimiento_mensual(fact_pedidos: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    mensual = por_tiempo(fact_pedidos, [], ["anio", "mes"], sumas()).select(
        "anio", "mes", F.col("n").alias("pedidos_mes"), ingresos().alias("ingresos_mes"),
        ticket().alias("ticket_promedio_mes"), F.col("items").alias("items_mes"),
    )
    return (
        _previo(mensual, ["anio", "mes"], pedidos_mes_anterior="pedidos_mes", ingresos_mes_anterior="ingresos_mes")
        .withColumn("crecimiento_pedidos_pct", crecimiento("pedidos_mes", "pedidos_mes_anterior"))
        .withColumn("crecimiento_ingresos_pct", crecimiento("ingresos_mes", "ingresos_mes_anterior"))
        .orderBy("anio", "mes")
    )


def _con_provincia(fact_pedidos: DataFrame) -> DataFrame:
    return fact_pedidos.filter(F.col("provincia_restaurante") != SIN_UBICACION)


def expansion_geografica(fact_pedidos: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    distintos = {"restaurantes_activos": _con_fuente("id_restaurante"), "usuarios_activos": _con_fuente("id_usuario")}
    return (
        por_tiempo(_con_provincia(fact_pedidos), ["provincia_restaurante"], ["anio", "mes"], sumas(), distintos)
        .select(
            "anio", "mes", F.col("provincia_restaurante").alias("provincia"), *distintos,
            F.col("n").alias("total_transacciones"), ingresos().alias("volumen_negocio"), ticket().alias("ticket_promedio"),
            entrega().alias("tasa_completitud_pct"),
        )
        .orderBy(F.desc("anio"), F.desc("mes"), F.desc("volumen_negocio"), "provincia")
    )


def flujos_interprovinciales(fact_pedidos: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    con_flujo = fact_pedidos.dropna(subset=["provincia_cliente", "provincia_restaurante"]).withColumn(
        "tipo_flujo", tipo_flujo()
    )
    distintos = {"usuarios_participantes": _con_fuente("id_usuario")}
    return (
        por_tiempo(con_flujo, ["tipo_flujo"], ["anio", "mes"], sumas(), distintos)
        .select("anio", "mes", "tipo_flujo", F.col("n").alias("pedidos_totales"), ingresos().alias("valor_total"),
                ticket().alias("ticket_promedio"), *distintos)
        .orderBy(F.desc("anio"), F.desc("mes"), "tipo_flujo")
    )


def crecimiento_trimestral(fact_pedidos: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    trimestral = por_tiempo(
        fact_pedidos, [], ["anio", "trimestre"], sumas(), distintos_tiempo={"dias_activos": "fecha"}
    ).withColumn("ingresos_trimestre", ingresos())
    return (
        _previo(trimestral, ["anio", "trimestre"], n_anterior="n", ingresos_anterior="ingresos_trimestre")
        .orderBy("anio", "trimestre")
        .select(
            "anio", cal.etiqueta(F.col("trimestre"), cal.NOMBRES_TRIMESTRE, "Desconocido").alias("periodo"),
            F.col("n").alias("pedidos_trimestre"), "ingresos_trimestre", ticket().alias("ticket_promedio_trim"),
            "dias_activos", crecimiento("n", "n_anterior").alias("crecimiento_pedidos_pct"),
            crecimiento("ingresos_trimestre", "ingresos_anterior").alias("crecimiento_ingresos_pct"),
        )
    )


def resumen_general(fact_pedidos: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    return por_tiempo(
        fact_pedidos, [], [], sumas(), distintos_tiempo={"dias_con_datos": "fecha"}
    ).select(
        "dias_con_datos", F.coalesce("n", F.lit(0)).alias("pedidos_totales"), ingresos().alias("ingresos_totales"),
        ticket().alias("ticket_promedio_general"), F.col("items").alias("items_totales"),
        F.col("pedidos_entregados").alias("pedidos_completados"), entrega().alias("tasa_completitud_global"),
    )


def ranking_provincias(fact_pedidos: DataFrame) -> DataFrame:
    return (
        _con_provincia(fact_pedidos)
        .groupBy(F.col("provincia_restaurante").alias("provincia"))
        .agg(
            *[F.sum(c).alias(n) for n, c in sumas().items()],
            F.count_distinct(_con_fuente("id_restaurante")).alias("restaurantes_activos"),
            F.count_distinct(_con_fuente("id_usuario")).alias("usuarios_activos"),
        )
        .select(
            "provincia", F.col("n").alias("transacciones_totales"), ingresos().alias("volumen_total"),
            "restaurantes_activos", "usuarios_activos", ticket().alias("ticket_promedio"),
            entrega().alias("tasa_completitud_promedio"),
        )
        .orderBy(F.desc("volumen_total"), "provincia")
    )


def resumen_reservas(fact_reservas: DataFrame) -> DataFrame:
    estados = conteos("estado", {"confirmadas": "confirmada", "pendientes": "pendiente", "canceladas": "cancelada"})
    return fact_reservas.agg(
        F.count("id_reserva").alias("reservas_totales"), *[F.sum(c).alias(n) for n, c in estados.items()]
    ).select(
        "reservas_totales", *estados, pct("confirmadas", "reservas_totales").alias("tasa_confirmacion_promedio")
    )
