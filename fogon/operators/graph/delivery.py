"""Drivers, distances, assignment and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fogon.functions.geo import distancia_km
from fogon.functions.knn import k_nearest
from fogon.functions.measures import o_cero, pct, razon
from fogon.functions.pairs import BLOQUE, pairs_within
from fogon.functions.sizing import never_broadcast


def _in_sources(df: DataFrame, sources: list[str] | None) -> DataFrame:
    return df if sources is None else df.filter(F.col("source_db").isin(sources))


def _km(lat: str, lng: str, lat_b: str, lng_b: str) -> Column:
    return distancia_km(F.col(lat), F.col(lng), F.col(lat_b), F.col(lng_b))


def available_drivers(repartidores: DataFrame) -> DataFrame:
    return repartidores.filter(
        (F.col("estado") == "disponible") & F.col("latitud_actual").isNotNull() & F.col("longitud_actual").isNotNull()
    )


def driver_distances(restaurantes: DataFrame, repartidores: DataFrame, k: int) -> DataFrame:
    """DISTANCIA edges from each restaurant to its k nearest available drivers.

    Nothing reads past the nearest few drivers, so the edges of all restaurant × driver pairs are not made.
    """
    conductores = available_drivers(repartidores).select(
        "source_db", "id_repartidor", F.col("nombre").alias("repartidor"), "latitud_actual", "longitud_actual"
    )
    cercanos = k_nearest(
        restaurantes.select("source_db", "id_restaurante", F.col("nombre").alias("restaurante"), "latitud", "longitud"),
        conductores, k, ("latitud", "longitud"), ("latitud_actual", "longitud_actual"), "id_repartidor", ["source_db"],
    )
    return cercanos.drop("latitud", "longitud").join(never_broadcast(conductores), ["source_db", "id_repartidor"]).select(
        "source_db", "id_restaurante", "restaurante", "id_repartidor", "repartidor",
        F.col("latitud_actual").alias("latitud"), F.col("longitud_actual").alias("longitud"), "distancia_km", "puesto",
    )


def nearest_driver(distancias: DataFrame) -> DataFrame:
    return distancias.filter("puesto = 1").select(
        "source_db", "id_restaurante", "id_repartidor", F.col("repartidor").alias("nombre"), "latitud", "longitud",
        F.round("distancia_km", 2).alias("distancia_km"),
    )


def k_nearest_drivers(restaurantes: DataFrame, repartidores: DataFrame, k: int = 5) -> DataFrame:
    """The k nearest available drivers of each restaurant, for any k."""
    return driver_distances(restaurantes, repartidores, k).select(
        "source_db", "id_restaurante", "restaurante", "id_repartidor", "repartidor",
        F.col("latitud").alias("repartidor_lat"), F.col("longitud").alias("repartidor_lng"), "distancia_km",
        F.current_timestamp().alias("fecha_calculo"),
    )


def assign_drivers(pedidos: DataFrame, restaurantes: DataFrame, repartidores: DataFrame) -> DataFrame:
    """Nearest available driver for every pending order; orders that cannot be assigned carry the reason."""
    cercano = nearest_driver(driver_distances(restaurantes, repartidores, 1)).select(
        "source_db", "id_restaurante", F.col("id_repartidor").alias("id_asignado"), "nombre", "distancia_km"
    )
    ubicados = restaurantes.filter(F.col("latitud").isNotNull() & F.col("longitud").isNotNull()).select(
        "source_db", "id_restaurante", F.lit(True).alias("_ubicado")
    )
    llave = ["source_db", "id_restaurante"]
    motivo = (
        F.when(F.col("_ubicado").isNull(), "Restaurante no tiene ubicación configurada")
        .when(F.col("id_asignado").isNull(), "No hay repartidores disponibles con ubicación")
    )
    return (
        pedidos.filter(F.col("estado") == "pendiente").select("source_db", "id_pedido", "id_restaurante")
        .join(ubicados.join(cercano, llave, "left"), llave, "left")
        .select(
            "source_db", "id_pedido", "id_restaurante", F.col("id_asignado").alias("id_repartidor"), "nombre", "distancia_km",
            F.when(F.col("id_asignado").isNotNull(), "en preparacion").otherwise("pendiente").alias("estado"),
            motivo.alias("motivo"),
        )
    )


def users_by_driver(pedidos: DataFrame, usuarios: DataFrame) -> DataFrame:
    """Distinct users with undelivered orders, per driver."""
    abiertos = pedidos.filter((F.col("estado") != "entregado") & F.col("id_repartidor").isNotNull())
    return abiertos.select("source_db", "id_repartidor", "id_usuario").distinct().join(
        never_broadcast(usuarios), ["id_usuario", "source_db"]
    )


def delivery_stops(asignados: DataFrame, repartidores: DataFrame) -> DataFrame:
    """Users to visit with their own and their driver's coordinates."""
    return asignados.select("source_db", "id_repartidor", "id_usuario", "nombre", "latitud", "longitud").join(
        never_broadcast(repartidores.select("source_db", "id_repartidor", "latitud_actual", "longitud_actual")), ["source_db", "id_repartidor"]
    )


def delivery_distances(stops: DataFrame) -> DataFrame:
    """DISTANCIA_ENTREGA edges: driver → user to visit."""
    return stops.select(
        "source_db", "id_repartidor", "id_usuario", "nombre", "latitud", "longitud",
        _km("latitud_actual", "longitud_actual", "latitud", "longitud").alias("distancia_km"),
    )


def stop_matrix(stops: DataFrame, bloque: int = BLOQUE) -> DataFrame:
    """Distances between the users one driver has to visit, in both directions.

    The matrix itself is the result. ``routes`` does not use it.
    """
    lugares = stops.select("source_db", "id_repartidor", "id_usuario", "latitud", "longitud")
    pares = pairs_within(lugares, ["source_db", "id_repartidor"], "id_usuario", bloque)
    sentidos = [
        F.struct(F.col(f"id_usuario{a}").alias("desde"), F.col(f"id_usuario{b}").alias("hasta")) for a, b in ((1, 2), (2, 1))
    ]
    return pares.select(
        "source_db", "id_repartidor", F.inline(F.array(*sentidos)),
        _km("latitud1", "longitud1", "latitud2", "longitud2").alias("distancia_km"),
    )


def nearest_stops(stops: DataFrame, k: int = 5) -> DataFrame:
    """The k nearest other stops of every stop of a driver, ``puesto`` 1 the nearest (of equal distances the smaller id).

    Linear in the stops, where ``stop_matrix`` has a row for each pair. Stops without an id or a place take no part.
    """
    chofer = ["source_db", "id_repartidor"]
    lugares = stops.select(*chofer, F.col("id_usuario").alias("desde"), "latitud", "longitud").dropna(subset=["desde"])
    destinos = lugares.withColumnRenamed("desde", "hasta")
    # A stop may be its own neighbour, so one more is asked for.
    cercanas = k_nearest(lugares, destinos, k + 1, ("latitud", "longitud"), ("latitud", "longitud"), "hasta", chofer)
    otras = cercanas.filter("hasta <> desde").drop("puesto")
    puesto = F.row_number().over(Window.partitionBy(*chofer, "desde").orderBy("distancia_km", "hasta"))
    return otras.select(*chofer, "desde", "hasta", "distancia_km", puesto.alias("puesto")).filter(F.col("puesto") <= k)


# --- Reports ------------------------------------------------------------------------------------------


def _con_pedidos(nodos: DataFrame, aristas: DataFrame, clave: str, sources: list[str] | None) -> DataFrame:
    """Nodes with the number of their orders, 0 included."""
    conteo = _in_sources(aristas, sources).groupBy(clave, "source_db").agg(F.count(F.lit(1)).alias("n"))
    return _in_sources(nodos, sources).join(conteo, [clave, "source_db"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def top_drivers(
    repartidores: DataFrame, asignado: DataFrame, sources: list[str] | None = None, limit: int | None = 20
) -> DataFrame:
    """Drivers by number of orders; ``limit`` cuts the list, None keeps all."""
    todos = (
        _con_pedidos(repartidores, asignado, "id_repartidor", sources)
        .select("id_repartidor", F.col("nombre").alias("nombre_repartidor"), F.col("source_db").alias("fuente_datos"),
                F.col("latitud_actual").alias("latitud"), F.col("longitud_actual").alias("longitud"),
                F.col("n").alias("total_pedidos_asignados"))
    )
    orden = [F.desc("total_pedidos_asignados"), "nombre_repartidor", "id_repartidor", "fuente_datos"]
    return todos if limit is None else todos.orderBy(*orden).limit(limit)


def driver_activity(top: DataFrame) -> DataFrame:
    """Leader, mean of the active drivers and their share, over all drivers (``top_drivers`` without a limit)."""
    n = F.col("total_pedidos_asignados")
    return top.agg(
        F.min_by("nombre_repartidor", F.struct(-n, "nombre_repartidor")).alias("lider"), F.max(n).alias("pedidos_lider"),
        F.round(F.avg(F.when(n > 0, n)), 4).alias("promedio_activos"), F.count(F.when(n > 0, 1)).alias("activos"),
        o_cero(pct(F.count(F.when(n > 0, 1)), F.count(F.lit(1)))).alias("actividad_pct"),
    )


def top_restaurants(
    restaurantes: DataFrame, proviene: DataFrame, sources: list[str] | None = None, limit: int = 20
) -> DataFrame:
    return (
        _con_pedidos(restaurantes, proviene, "id_restaurante", sources)
        .select("id_restaurante", F.col("nombre").alias("nombre_restaurante"), F.col("source_db").alias("fuente_datos"),
                "latitud", "longitud", F.col("n").alias("total_pedidos_recibidos"))
        .orderBy(F.desc("total_pedidos_recibidos"), "nombre_restaurante", "id_restaurante", "fuente_datos").limit(limit)
    )


def restaurant_distribution(top: DataFrame, n: int = 10) -> DataFrame:
    """Share of each of the first active restaurants in the orders of all of them."""
    primeros = top.filter("total_pedidos_recibidos > 0").orderBy(
        F.desc("total_pedidos_recibidos"), "nombre_restaurante", "id_restaurante", "fuente_datos"
    ).limit(n)
    total = primeros.agg(F.sum("total_pedidos_recibidos")).scalar()
    return primeros.select(
        "id_restaurante", "nombre_restaurante", "fuente_datos", "total_pedidos_recibidos",
        pct(F.col("total_pedidos_recibidos"), total).alias("porcentaje"),
    )


def delivery_metrics(
    nodos: dict[str, DataFrame], asignado: DataFrame, proviene: DataFrame, sources: list[str] | None = None
) -> DataFrame:
    partes = {
        "total_repartidores": nodos["Repartidor"], "total_restaurantes": nodos["Restaurante"],
        "total_usuarios": nodos["Usuario"], "total_pedidos": nodos["Pedido"],
        "pedidos_asignados": asignado, "pedidos_con_restaurante": proviene,
    }
    total = None
    for nombre, df in partes.items():
        fila = _in_sources(df, sources).agg(F.count(F.lit(1)).alias("n")).select(F.lit(nombre).alias("que"), "n")
        total = fila if total is None else total.unionAll(fila)
    return total.agg(*[F.sum(F.when(F.col("que") == nombre, F.col("n"))).alias(nombre) for nombre in partes])


def delivery_rates(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        o_cero(pct("pedidos_asignados", "total_pedidos")).alias("tasa_asignacion_pct"),
        o_cero(pct("pedidos_con_restaurante", "total_pedidos")).alias("tasa_restaurante_pct"),
        o_cero(F.round(razon("pedidos_asignados", "total_repartidores"), 2)).alias("pedidos_por_repartidor"),
    )


def driver_efficiency(
    repartidores: DataFrame, asignado: DataFrame, entrega: DataFrame, sources: list[str] | None = None
) -> DataFrame:
    """Orders and distances per driver; both sides are summed before the joins, so they do not multiply."""
    llave = ["id_repartidor", "source_db"]
    distancias = _in_sources(entrega, sources).groupBy(*llave).agg(
        F.count_distinct("id_usuario").alias("usuarios"), F.avg("distancia_km").alias("media"),
        F.min("distancia_km").alias("minima"), F.max("distancia_km").alias("maxima"),
    )
    return (
        _con_pedidos(repartidores, asignado, "id_repartidor", sources)
        .join(distancias, llave, "left")
        .withColumn("usuarios", F.coalesce("usuarios", F.lit(0)))
        .filter("n > 0 or usuarios > 0")
        .select(
            "id_repartidor", F.col("nombre").alias("nombre_repartidor"), F.col("source_db").alias("fuente_datos"),
            F.col("n").alias("pedidos_asignados"), F.col("usuarios").alias("usuarios_en_rango"),
            o_cero(F.col("media")).alias("distancia_promedio_km"), o_cero(F.col("minima")).alias("distancia_minima_km"),
            o_cero(F.col("maxima")).alias("distancia_maxima_km"),
            o_cero(F.when(F.col("n") > 0, F.round(razon("n", "media"), 2))).alias("eficiencia_pedidos_por_km"),
        )
        .orderBy(F.desc("eficiencia_pedidos_por_km"), F.desc("pedidos_asignados"), "id_repartidor", "fuente_datos")
    )


def efficiency_ranking(eficiencia: DataFrame, n: int = 10) -> DataFrame:
    """Most efficient drivers next to the means over all analysed drivers."""
    medias = eficiencia.agg(
        F.round(F.avg("eficiencia_pedidos_por_km"), 4).alias("eficiencia_promedio"),
        F.round(F.avg("distancia_promedio_km"), 4).alias("distancia_promedio"), F.count(F.lit(1)).alias("analizados"),
    )
    return (
        eficiencia.filter("eficiencia_pedidos_por_km > 0")
        .orderBy(F.desc("eficiencia_pedidos_por_km"), F.desc("pedidos_asignados"), "id_repartidor", "fuente_datos").limit(n)
        .select("id_repartidor", "nombre_repartidor", "fuente_datos", "pedidos_asignados", "eficiencia_pedidos_por_km")
        .withColumns({c: medias.select(c).scalar() for c in ("eficiencia_promedio", "distancia_promedio", "analizados")})
    )


def delivery_chains(
    proviene: DataFrame, asignado: DataFrame, pertenece: DataFrame, sources: list[str] | None = None, limit: int | None = None
) -> DataFrame:
    """Restaurant ← order → driver and order → user, one row per order that has all three."""
    llave = ["id_pedido", "source_db"]
    cadenas = _in_sources(proviene, sources).join(asignado, llave).join(pertenece, llave).select(
        "id_restaurante", "id_pedido", "id_repartidor", "id_usuario", "source_db"
    )
    return cadenas if limit is None else cadenas.orderBy("id_pedido", "source_db").limit(limit)


def restaurant_subgraph(
    restaurantes: DataFrame, proviene: DataFrame, contiene: DataFrame, pertenece: DataFrame, asignado: DataFrame,
    id_restaurante: int | None = None,
) -> DataFrame:
    """Orders, products, users and drivers around each restaurant (or one), all optional.

    A busy restaurant or a long order would be the side of an outer join that cannot be split. So what matches
    is joined inner (there either side may be split), and what has no match is added by anti-joins with
    distinct keys.
    """
    sitio, llave = ["id_restaurante", "source_db"], ["id_pedido", "source_db"]
    nodos = restaurantes if id_restaurante is None else restaurantes.filter(F.col("id_restaurante") == id_restaurante)
    nodos = nodos.select(*sitio)
    pedidos = proviene.join(never_broadcast(nodos), sitio, "left_semi")
    filas = (
        contiene.join(pedidos, llave)
        .unionByName(pedidos.join(contiene.select(*llave).distinct(), llave, "left_anti"), allowMissingColumns=True)
        # One user and at most one driver per order.
        .join(pertenece, llave, "left").join(asignado, llave, "left")
        .unionByName(nodos.join(proviene.select(*sitio).distinct(), sitio, "left_anti"), allowMissingColumns=True)
    )
    return filas.select("id_restaurante", "source_db", "id_pedido", "id_producto", "cantidad", "id_usuario", "id_repartidor")
