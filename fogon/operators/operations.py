"""Set-wide operational reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fogon.operators.maintenance import nest_orders

ESTADOS_ABIERTOS = ["pendiente", "en preparacion", "listo"]


def open_orders_by_driver(pedido: DataFrame, detalle: DataFrame) -> DataFrame:
    """Open orders of each driver, oldest first, with their lines."""
    abiertos = pedido.filter(F.col("estado").isin(ESTADOS_ABIERTOS) & F.col("id_repartidor").isNotNull())
    # Only the lines of open orders are gathered.
    lineas = detalle.join(abiertos.select("id_pedido"), "id_pedido", "left_semi")
    return nest_orders(abiertos, lineas).orderBy("id_repartidor", "fecha_hora", "id_pedido")


def unassigned_orders(pedido: DataFrame) -> DataFrame:
    return pedido.filter(F.col("id_repartidor").isNull() & (F.col("estado") == "pendiente")).orderBy("fecha_hora", "id_pedido")


CAMPOS_REPARTIDOR = ["id_repartidor", "nombre", "telefono", "vehiculo", "latitud_actual", "longitud_actual", "estado"]


def available_drivers(repartidor: DataFrame) -> DataFrame:
    return (
        repartidor.filter(F.col("estado") == "disponible").select(*CAMPOS_REPARTIDOR).orderBy("nombre", "id_repartidor")
    )


def available_with_location(repartidor: DataFrame) -> DataFrame:
    return available_drivers(repartidor).dropna(subset=["latitud_actual", "longitud_actual"])


CAMPOS_USUARIO = ["id_usuario", "nombre", "email", "rol", "latitud", "longitud", "direccion_completa", "id_referido"]


def users_by_driver(pedido: DataFrame, usuario: DataFrame) -> DataFrame:
    """Users with undelivered orders of each driver; (driver, user) pairs are distinct before the join."""
    pares = (
        pedido.filter((F.col("estado") != "entregado") & F.col("id_repartidor").isNotNull())
        .select("id_repartidor", "id_usuario").distinct()
    )
    return pares.join(usuario.select(*CAMPOS_USUARIO), "id_usuario").orderBy("id_repartidor", "nombre", "id_usuario")


def _recent_users(usuario: DataFrame) -> DataFrame:
    return usuario.select(*CAMPOS_USUARIO, "fecha_registro").orderBy(F.desc("fecha_registro"), "id_usuario")


def users_with_location(usuario: DataFrame) -> DataFrame:
    return _recent_users(usuario.dropna(subset=["latitud", "longitud"]))


def users_with_referrer(usuario: DataFrame) -> DataFrame:
    return _recent_users(usuario.dropna(subset=["id_referido"]))


def restaurants_with_location(restaurante: DataFrame) -> DataFrame:
    return (
        restaurante.dropna(subset=["latitud", "longitud"])
        .select("id_restaurante", "nombre", "direccion", "id_admin", "latitud", "longitud").orderBy("id_restaurante")
    )


def list_entity(df: DataFrame, keys: list) -> DataFrame:
    return df.orderBy(*keys)
