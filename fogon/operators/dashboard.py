"""Dashboard queries over the facts, and the tables derived from their results.

Derived tables take the base DataFrame, which holds one row per period, province, category or hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fogon.functions import calendar as cal
from fogon.functions.geo import PROVINCIAS, SIN_UBICACION
from fogon.functions.measures import doble, o_cero, pct, por_tiempo, razon, uno_si
from fogon.functions.ordered import join_nullsafe, median
from fogon.operators.cubes import CLAVE_PRODUCTO, con_producto, externo

# Names of the source filter.
FUENTE_POR_NOMBRE = {"PostgreSQL": "postgres", "MongoDB": "mongo", "Todos": None}


def filter_source(df: DataFrame, source: str = "Todos") -> DataFrame:
    fuente = FUENTE_POR_NOMBRE[source]
    return df if fuente is None else df.filter(F.col("fuente_datos") == fuente)


def _vendidos(fact_pedidos: DataFrame, source: str) -> DataFrame:
    return filter_source(fact_pedidos, source).filter("total_pedido > 0")


def sumas() -> dict[str, Column]:
    """Additive measures of an order row."""
    return {"n": uno_si(F.col("id_pedido").isNotNull()), "filas": F.lit(1), "monto": F.col("total_pedido"),
            "items": F.col("cantidad_items"), "entregados": uno_si(F.col("estado") == "entregado"),
            "externos": uno_si(externo())}


def ingresos() -> Column:
    return o_cero(doble("monto"))


def ticket() -> Column:
    return F.round(razon("monto", "filas"), 2)



def kpis(fact_pedidos: DataFrame, dim_tiempo: DataFrame, source: str = "Todos") -> DataFrame:
    return por_tiempo(
        _vendidos(fact_pedidos, source), [], [], sumas(), distintos_tiempo={"dias_activos": "fecha"}
    ).select(
        "dias_activos", F.coalesce("n", F.lit(0)).alias("pedidos_totales"), ingresos().alias("ingresos_totales"),
        ticket().alias("ticket_promedio_general"), F.col("entregados").alias("pedidos_entregados"),
        F.coalesce("items", F.lit(0)).alias("items_totales"),
    )


def kpis_derivados(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        o_cero(pct("pedidos_entregados", "pedidos_totales")).alias("tasa_entrega_pct"),
        o_cero(razon("pedidos_totales", "dias_activos")).alias("pedidos_por_dia"),
    )


_GRANOS: dict[str, list[str]] = {"dia": ["fecha"], "mes": ["anio", "mes"], "trimestre": ["anio", "trimestre"]}


def _periodo(grano: str) -> Column:
    anio = F.col("anio").cast("string")
    if grano == "dia":
        return F.col("fecha")
    if grano == "mes":
        return F.concat_ws("-", anio, F.lpad(F.col("mes").cast("string"), 2, "0"))
    return F.concat(anio, F.lit("-Q"), F.col("trimestre").cast("string"))


def tendencia(fact_pedidos: DataFrame, dim_tiempo: DataFrame, source: str = "Todos", grano: str = "dia") -> DataFrame:
    return (
        por_tiempo(_vendidos(fact_pedidos, source), [], _GRANOS[grano], sumas())
        .select(_periodo(grano).alias("periodo"), F.col("n").alias("pedidos"), ingresos().alias("ingresos"),
                ticket().alias("ticket_promedio"), F.coalesce("items", F.lit(0)).alias("items"))
        .orderBy("periodo")
    )


def _mayor(etiqueta: str, medida: str) -> Column:
    """Label with the largest measure; of equals the smallest label."""
    return F.min_by(etiqueta, F.struct(-doble(medida), F.col(etiqueta)))


def _menor(etiqueta: str, medida: str) -> Column:
    return F.min_by(etiqueta, F.struct(doble(medida), F.col(etiqueta)))


def _suma(col: str) -> Column:
    return F.round(F.sum(doble(col)), 2)


def _media(col: str, digits: int = 2) -> Column:
    return F.round(F.avg(doble(col)), digits)


def resumen_tendencia(tendencia: DataFrame) -> DataFrame:
    return tendencia.agg(
        F.count(F.lit(1)).alias("periodos"), F.sum("pedidos").alias("total_pedidos"),
        _suma("ingresos").alias("total_ingresos"), _media("ticket_promedio").alias("ticket_promedio"),
        F.sum("items").alias("total_items"), _mayor("periodo", "ingresos").alias("mejor_periodo"),
        _menor("periodo", "ingresos").alias("peor_periodo"),
    )


METRICAS_TENDENCIA = ["pedidos", "ingresos", "ticket_promedio", "items"]


def estadisticas_tendencia(tendencia: DataFrame) -> DataFrame:
    largo = tendencia.select(*[doble(m).alias(m) for m in METRICAS_TENDENCIA]).unpivot(
        [], METRICAS_TENDENCIA, "metrica", "valor"
    )
    return largo.groupBy("metrica").agg(
        _media("valor").alias("promedio"), F.max("valor").alias("maximo"), F.min("valor").alias("minimo")
    )


def crecimiento_promedio(tendencia: DataFrame, col: str = "ingresos") -> DataFrame:
    """Mean growth between consecutive periods, skipping those whose predecessor is not positive.

    The window is over periods (days at most), never over orders.
    """
    previo = F.lag(doble(col)).over(Window.partitionBy().orderBy("periodo"))
    cambio = tendencia.withColumn("_previo", previo).filter("_previo > 0")
    cambio = cambio.select(((doble(col) - F.col("_previo")) / F.col("_previo") * 100).alias("c"))
    return cambio.agg(F.round(o_cero(F.avg("c")), 4).alias("crecimiento_promedio_pct"))


def _por_provincia(fact_pedidos: DataFrame, source: str, columna: str, u: str, r: str) -> DataFrame:
    return (
        _vendidos(fact_pedidos, source)
        .filter(F.col(columna) != SIN_UBICACION)
        .groupBy(F.col(columna).alias("provincia"))
        .agg(*[F.sum(c).alias(n) for n, c in sumas().items()],
             F.count_distinct("id_usuario").alias(u), F.count_distinct("id_restaurante").alias(r))
        .orderBy(F.desc("monto"), "provincia")
    )


def geo_restaurantes(fact_pedidos: DataFrame, source: str = "Todos") -> DataFrame:
    return _por_provincia(fact_pedidos, source, "provincia_restaurante", "clientes_atendidos", "restaurantes_activos").select(
        "provincia", F.col("n").alias("total_pedidos"), ingresos().alias("ingresos_totales"), ticket().alias("ticket_promedio"),
        "restaurantes_activos", "clientes_atendidos", pct("externos", "filas", 1).alias("pct_clientes_externos"),
    )


def geo_clientes(fact_pedidos: DataFrame, source: str = "Todos") -> DataFrame:
    return _por_provincia(fact_pedidos, source, "provincia_cliente", "usuarios_activos", "restaurantes_utilizados").select(
        "provincia", F.col("n").alias("total_pedidos"), ingresos().alias("ingresos_generados"), ticket().alias("ticket_promedio"),
        "usuarios_activos", "restaurantes_utilizados", pct("externos", "filas", 1).alias("pct_pedidos_externos"),
    )


def locales_vs_externos(geo_clientes: DataFrame) -> DataFrame:
    n, externos = doble("total_pedidos"), F.col("pct_pedidos_externos")
    return geo_clientes.select(
        "provincia",
        F.inline(F.array(
            F.struct(F.lit("Pedidos Locales").alias("tipo"), (n * (100 - externos) / 100).alias("cantidad")),
            F.struct(F.lit("Pedidos Externos").alias("tipo"), (n * externos / 100).alias("cantidad")),
        )),
    )


def flujos(fact_pedidos: DataFrame, source: str = "Todos") -> DataFrame:
    con_info = (F.col("provincia_cliente") != SIN_UBICACION) & (F.col("provincia_restaurante") != SIN_UBICACION)
    return (
        _vendidos(fact_pedidos, source)
        .filter(con_info)
        .groupBy(F.col("provincia_cliente").alias("origen"), F.col("provincia_restaurante").alias("destino"))
        .agg(F.count("id_pedido").alias("pedidos"), F.round(doble(F.sum("total_pedido")), 2).alias("valor_flujo"))
        .filter("pedidos > 0")
        .orderBy(F.desc("valor_flujo"), "origen", "destino")
    )


def matriz_flujos(flujos: DataFrame) -> DataFrame:
    """Origin × destination matrix of order counts; destinations are the known provinces."""
    return flujos.groupBy("origen").pivot("destino", PROVINCIAS).agg(F.sum("pedidos")).na.fill(0)


def top_flujos(flujos: DataFrame, n: int = 10) -> DataFrame:
    return (
        flujos.orderBy(F.desc("valor_flujo"), "origen", "destino").limit(n)
        .select(F.concat_ws(" → ", "origen", "destino").alias("flujo"), "pedidos", "valor_flujo")
    )


def resumen_geo(geo_restaurantes: DataFrame, geo_clientes: DataFrame, flujos: DataFrame) -> DataFrame:
    """One row per analysis: size, sums, leader and the largest external share."""

    def seccion(df: DataFrame, tipo: str, valor: str, restaurantes: str, usuarios: str, externos: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("filas"), F.sum("total_pedidos").alias("total_pedidos"), _suma(valor).alias("total_valor"),
            F.sum(restaurantes).alias("restaurantes"), F.sum(usuarios).alias("usuarios"),
            _mayor("provincia", valor).alias("lider"), _mayor("provincia", externos).alias("mas_externa"),
            F.max(externos).alias("mayor_pct_externos"),
        ).select(F.lit(tipo).alias("analisis"), "*")

    flujo = flujos.withColumn("flujo", F.concat_ws(" → ", "origen", "destino")).agg(
        F.count(F.lit(1)).alias("filas"), F.sum("pedidos").alias("total_pedidos"), _suma("valor_flujo").alias("total_valor"),
        _mayor("flujo", "valor_flujo").alias("lider"),
    ).select(F.lit("flujos").alias("analisis"), "*")
    return (
        seccion(geo_restaurantes, "restaurantes", "ingresos_totales", "restaurantes_activos", "clientes_atendidos",
                "pct_clientes_externos")
        .unionByName(seccion(geo_clientes, "clientes", "ingresos_generados", "restaurantes_utilizados", "usuarios_activos",
                             "pct_pedidos_externos"))
        .unionByName(flujo, allowMissingColumns=True)
    )


def _lineas_vendidas(fact_detalle: DataFrame, source: str) -> DataFrame:
    return filter_source(fact_detalle, source).filter("subtotal > 0")


def _medidas_linea() -> list[Column]:
    return [
        F.count("id_producto").alias("n"), F.sum("subtotal").alias("monto"), F.sum("cantidad").alias("unidades"),
        F.count("cantidad").alias("n_cantidades"), F.sum("precio_unitario").alias("precios"),
        F.count("precio_unitario").alias("n_precios"),
    ]


def precio_medio() -> Column:
    return F.round(razon("precios", "n_precios"), 2)


def cantidad_media() -> Column:
    return F.round(razon("unidades", "n_cantidades"), 2)



def analisis_categorias(fact_detalle: DataFrame, dim_categorias: DataFrame, source: str = "Todos") -> DataFrame:
    return (
        _lineas_vendidas(fact_detalle, source)
        .groupBy("categoria_id")
        .agg(*_medidas_linea(), F.count_distinct("id_producto").alias("productos_unicos"))
        .join(dim_categorias, "categoria_id")
        .orderBy(F.desc("monto"), "nombre_categoria")
        .select("nombre_categoria", F.col("n").alias("ventas_totales"), ingresos().alias("ingresos"),
                F.coalesce("unidades", F.lit(0)).alias("unidades"), precio_medio().alias("precio_promedio"), "productos_unicos",
                cantidad_media().alias("cantidad_promedio_por_venta"))
    )


def top_productos(
    fact_detalle: DataFrame, dim_productos: DataFrame, dim_categorias: DataFrame, source: str = "Todos", n: int = 20
) -> DataFrame:
    por_producto = _lineas_vendidas(fact_detalle, source).groupBy(*CLAVE_PRODUCTO).agg(*_medidas_linea())
    sumas = ["n", "monto", "unidades", "n_cantidades", "precios", "n_precios"]
    return (
        con_producto(por_producto, dim_productos, dim_categorias)
        .groupBy("nombre", "nombre_categoria")
        .agg(*[F.sum(c).alias(c) for c in sumas])
        .orderBy(F.desc("monto"), "nombre", "nombre_categoria")
        .limit(n)
        .select("nombre", "nombre_categoria", F.col("n").alias("ventas_totales"), ingresos().alias("ingresos"),
                F.coalesce("unidades", F.lit(0)).alias("unidades_vendidas"), precio_medio().alias("precio_promedio"),
                cantidad_media().alias("cantidad_promedio_por_pedido"))
    )


def reordenar(top: DataFrame, metric: str = "ingresos", n: int = 15) -> DataFrame:
    return top.orderBy(F.desc(metric), "nombre", "nombre_categoria").limit(n)


def distribucion_top(top: DataFrame) -> DataFrame:
    """Products per category among the top, next to the means over the whole top."""
    medias = top.agg(
        _media("ingresos").alias("ingresos_promedio"), _media("unidades_vendidas").alias("unidades_promedio"),
        _media("ventas_totales").alias("ventas_promedio"),
    )
    return top.groupBy("nombre_categoria").agg(F.count(F.lit(1)).alias("productos")).withColumns(
        {c: medias.select(c).scalar() for c in ("ingresos_promedio", "unidades_promedio", "ventas_promedio")}
    )


def analisis_precios(fact_detalle: DataFrame, dim_categorias: DataFrame, source: str = "Todos") -> DataFrame:
    """Price statistics per category; the median is exact and computed without gathering a category's prices."""
    lineas = _lineas_vendidas(fact_detalle, source)
    base = lineas.groupBy("categoria_id").agg(
        *_medidas_linea(), F.min("precio_unitario").alias("minimo"), F.max("precio_unitario").alias("maximo"),
        F.count_distinct("id_producto").alias("productos_en_categoria"),
    )
    medianas = median(lineas, ["categoria_id"], "precio_unitario", "mediana")
    return (
        join_nullsafe(base, medianas, ["categoria_id"], "left")
        .join(dim_categorias, "categoria_id")
        .orderBy(F.desc(razon("precios", "n_precios")), "nombre_categoria")
        .select(
            "nombre_categoria", doble("minimo").alias("precio_minimo"), doble("maximo").alias("precio_maximo"),
            precio_medio().alias("precio_promedio"), F.round("mediana", 2).alias("precio_mediano"),
            "productos_en_categoria", ingresos().alias("ingresos_categoria"),
            doble(F.col("maximo") - F.col("minimo")).alias("rango_precios"),
        )
    )


def resumen_productos(categorias: DataFrame, top: DataFrame, precios: DataFrame) -> DataFrame:
    """One row per analysis of products: size, sums, leaders and overall mean price."""
    c = categorias.agg(
        F.count(F.lit(1)).alias("filas"), _suma("ingresos").alias("total_ingresos"), F.sum("unidades").alias("total_unidades"),
        F.sum("productos_unicos").alias("total_productos"), _mayor("nombre_categoria", "ingresos").alias("lider"),
        _mayor("nombre_categoria", "productos_unicos").alias("mas_productos"),
        _mayor("nombre_categoria", "precio_promedio").alias("mas_cara"), _media("precio_promedio").alias("precio_promedio"),
    ).select(F.lit("categorias").alias("analisis"), "*")
    p = top.agg(
        F.count(F.lit(1)).alias("filas"), _suma("ingresos").alias("total_ingresos"),
        F.sum("unidades_vendidas").alias("total_unidades"), F.sum("ventas_totales").alias("total_ventas"),
        _mayor("nombre", "ingresos").alias("lider"), _media("precio_promedio").alias("precio_promedio"),
    ).select(F.lit("productos").alias("analisis"), "*")
    r = precios.agg(
        F.count(F.lit(1)).alias("filas"), _suma("ingresos_categoria").alias("total_ingresos"),
        F.max("precio_maximo").alias("precio_maximo"), F.min("precio_minimo").alias("precio_minimo"),
        _mayor("nombre_categoria", "precio_promedio").alias("mas_cara"),
        _menor("nombre_categoria", "precio_promedio").alias("mas_barata"),
        _mayor("nombre_categoria", "rango_precios").alias("mayor_rango"), _media("precio_promedio").alias("precio_promedio"),
    ).select(F.lit("precios").alias("analisis"), "*")
    return c.unionByName(p, allowMissingColumns=True).unionByName(r, allowMissingColumns=True)


def por_dia_semana(fact_pedidos: DataFrame, dim_tiempo: DataFrame, source: str = "Todos") -> DataFrame:
    return (
        por_tiempo(_vendidos(fact_pedidos, source), [], ["dia_semana", "es_fin_semana"], sumas())
        .orderBy("dia_semana")
        .select("dia_semana", cal.nombre_dia(F.col("dia_semana")).alias("nombre_dia"), "es_fin_semana",
                F.col("n").alias("pedidos"), ingresos().alias("ingresos"), ticket().alias("ticket_promedio"))
    )


def resumen_finde(por_dia: DataFrame) -> DataFrame:
    return por_dia.groupBy("es_fin_semana").agg(
        F.sum("pedidos").alias("pedidos"), _suma("ingresos").alias("ingresos"),
        _media("ticket_promedio").alias("ticket_promedio"),
    ).withColumn("tipo", F.when(F.col("es_fin_semana"), "Fin de Semana").otherwise("Días Laborables"))


def por_hora(fact_pedidos: DataFrame, dim_tiempo: DataFrame, source: str = "Todos") -> DataFrame:
    return (
        por_tiempo(_vendidos(fact_pedidos, source), [], ["hora"], sumas(),
                   {"usuarios_activos": F.col("id_usuario")})
        .orderBy("hora")
        .select("hora", cal.periodo_dia(F.col("hora")).alias("periodo_dia"), F.col("n").alias("pedidos"),
                ingresos().alias("ingresos"), ticket().alias("ticket_promedio"), "usuarios_activos")
    )


def por_periodo_dia(por_hora: DataFrame) -> DataFrame:
    return por_hora.groupBy("periodo_dia").agg(
        F.sum("pedidos").alias("pedidos"), _suma("ingresos").alias("ingresos"),
        F.sum("usuarios_activos").alias("usuarios_activos"),
    )


def _hh00(hora: Column) -> Column:
    return F.format_string("%02d:00", hora)


def top_horas(por_hora: DataFrame, n: int = 5) -> DataFrame:
    return (
        por_hora.orderBy(F.desc("pedidos"), "hora").limit(n)
        .select(_hh00(F.col("hora")).alias("hora_formato"), "pedidos", "ingresos", "usuarios_activos")
    )


def pico_vs_normal(fact_pedidos: DataFrame, dim_tiempo: DataFrame, source: str = "Todos") -> DataFrame:
    return (
        por_tiempo(_vendidos(fact_pedidos, source), [], ["es_horario_pico"], sumas(),
                   {"usuarios_activos": F.col("id_usuario")}, {"horas_diferentes": "hora"})
        .orderBy(F.desc("es_horario_pico"))
        .select("es_horario_pico",
                F.when(F.col("es_horario_pico"), "Horario Pico").otherwise("Horario Normal").alias("tipo_horario"),
                F.col("n").alias("pedidos"), ingresos().alias("ingresos"), ticket().alias("ticket_promedio"),
                "usuarios_activos", "horas_diferentes")
    )


def participacion_pico(pico: DataFrame) -> DataFrame:
    """Peak figures, their difference to normal hours and the peak share of orders; a missing side is 0."""

    def lado(col: str, es_pico: bool) -> Column:
        return o_cero(F.sum(F.when(F.col("es_horario_pico") == es_pico, doble(col))))

    columnas = {}
    for c in ("pedidos", "ingresos", "ticket_promedio"):
        columnas[f"{c}_pico"] = lado(c, True)
        columnas[f"{c}_normal"] = lado(c, False)
        columnas[f"diferencia_{c}"] = F.round(lado(c, True) - lado(c, False), 2)
    columnas["horas_pico"] = lado("horas_diferentes", True)
    columnas["participacion_pico_pct"] = pct(lado("pedidos", True), lado("pedidos", True) + lado("pedidos", False))
    return pico.agg(*[c.alias(n) for n, c in columnas.items()])


def detalle_horas_pico(fact_pedidos: DataFrame, dim_tiempo: DataFrame, source: str = "Todos") -> DataFrame:
    return (
        por_tiempo(_vendidos(fact_pedidos, source), [], ["hora", "es_horario_pico"], sumas())
        .select("hora", "es_horario_pico", F.col("n").alias("pedidos_en_esta_hora"))
        .orderBy("hora")
    )


def lista_horas_pico(detalle_horas: DataFrame) -> DataFrame:
    horas = F.sort_array(F.collect_set(F.when(F.col("es_horario_pico"), F.col("hora"))))
    return detalle_horas.agg(F.array_join(F.transform(horas, _hh00), ", ").alias("horas_pico"))


def resumen_horarios(por_dia: DataFrame, por_hora: DataFrame, pico: DataFrame) -> DataFrame:
    """One row per schedule analysis: size, sums, busiest and quietest, mean ticket or sum of users."""
    comunes = [F.count(F.lit(1)).alias("filas"), F.sum("pedidos").alias("total_pedidos"), _suma("ingresos").alias("total_ingresos")]
    dias = por_dia.agg(
        *comunes, _mayor("nombre_dia", "pedidos").alias("mas_activo"), _menor("nombre_dia", "pedidos").alias("menos_activo"),
        _media("ticket_promedio").alias("ticket_promedio"),
    ).select(F.lit("dias").alias("analisis"), "*")
    horas = por_hora.withColumn("hh", _hh00(F.col("hora"))).agg(
        *comunes, _mayor("hh", "pedidos").alias("mas_activo"), _menor("hh", "pedidos").alias("menos_activo"),
        F.sum("usuarios_activos").alias("usuarios"),
    ).select(F.lit("horas").alias("analisis"), "*")
    tipos = pico.agg(
        *comunes, _media("ticket_promedio").alias("ticket_promedio"), F.sum("usuarios_activos").alias("usuarios")
    ).select(F.lit("pico").alias("analisis"), "*")
    return dias.unionByName(horas, allowMissingColumns=True).unionByName(tipos, allowMissingColumns=True)
