"""Set-wide forms of the write operations: pricing, nesting, updates, purges and constraint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reasons given for rejected order lines.
CANTIDAD_INVALIDA = "Producto inválido o cantidad incorrecta"
PRODUCTO_NO_ENCONTRADO = "Producto no encontrado"


def price_lines(requests: DataFrame, productos: DataFrame) -> DataFrame:
    """Requested lines with ``subtotal`` and, for rejected ones, ``motivo_rechazo``."""
    precios = productos.select("id_producto", F.col("precio").alias("_precio"), F.lit(True).alias("_existe"))
    motivo = (
        F.when(F.col("id_producto").isNull() | F.col("cantidad").isNull() | (F.col("cantidad") <= 0), CANTIDAD_INVALIDA)
        .when(F.col("_existe").isNull(), PRODUCTO_NO_ENCONTRADO)
    )
    return (
        requests.join(precios, "id_producto", "left")
        .withColumn("motivo_rechazo", motivo)
        .withColumn(
            "subtotal",
            F.when(F.col("motivo_rechazo").isNull(), F.round(F.col("_precio").cast("double") * F.col("cantidad"), 2)),
        )
        .select(*requests.columns, "subtotal", "motivo_rechazo")
    )


def nest_orders(pedido: DataFrame, detalle: DataFrame) -> DataFrame:
    """Orders with the array of their lines (empty when there is none), sorted by product.

    The array is the document itself, so an order is as large as its own lines and no larger.
    """
    linea = F.struct("id_producto", F.col("cantidad").cast("int").alias("cantidad"), F.col("subtotal").cast("double").alias("subtotal"))
    lineas = detalle.groupBy("id_pedido").agg(F.sort_array(F.collect_list(linea)).alias("detalles"))
    vacio = F.array().cast("array<struct<id_producto: bigint, cantidad: int, subtotal: double>>")
    return pedido.join(lineas, "id_pedido", "left").withColumn("detalles", F.coalesce("detalles", vacio))


def _apply(df: DataFrame, changes: DataFrame, clave: str, campos: list[str]) -> DataFrame:
    """One change row per key; a NULL field keeps the old value."""
    nuevos = changes.select(clave, *[F.col(c).alias(f"_n_{c}") for c in campos])
    return (
        df.join(nuevos, clave, "left")
        .withColumns({c: F.coalesce(f"_n_{c}", c) for c in campos})
        .select(*df.columns)
    )


def apply_order_updates(pedido: DataFrame, changes: DataFrame) -> DataFrame:
    return _apply(pedido, changes, "id_pedido", ["estado", "tipo", "fecha_hora", "id_repartidor"])


def apply_driver_updates(repartidor: DataFrame, changes: DataFrame) -> DataFrame:
    return _apply(repartidor, changes, "id_repartidor", ["latitud_actual", "longitud_actual", "estado"])


def purge_users(tables: dict[str, DataFrame], ids: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Remove users' reservations and orders, and the restaurants they own with all that hangs on them.

    ``tables``: restaurante, menu, producto, pedido (nested ``detalles``), reserva. ``ids`` has
    ``id_usuario``. Returns the surviving tables and a table of (entidad, eliminados).
    """
    duenos = ids.select(F.col("id_usuario").alias("id_admin"))
    fuera: dict[str, DataFrame] = {}
    fuera["restaurante"] = tables["restaurante"].join(duenos, "id_admin", "left_semi")
    r = fuera["restaurante"].select("id_restaurante")
    fuera["menu"] = tables["menu"].join(r, "id_restaurante", "left_semi")
    fuera["producto"] = tables["producto"].join(fuera["menu"].select("id_menu"), "id_menu", "left_semi")

    quedan = {
        "restaurante": tables["restaurante"].join(duenos, "id_admin", "left_anti"),
        "menu": tables["menu"].join(r, "id_restaurante", "left_anti"),
        "producto": tables["producto"].join(fuera["menu"].select("id_menu"), "id_menu", "left_anti"),
    }
    for entidad in ("pedido", "reserva"):
        vivos = tables[entidad].join(ids, "id_usuario", "left_anti")
        quedan[entidad] = vivos.join(r, "id_restaurante", "left_anti")
    quedan["pedido"] = pull_products(quedan["pedido"], fuera["producto"].select("id_producto"))

    resumen = None
    for entidad in ("reserva", "pedido", "restaurante", "menu", "producto"):
        n = tables[entidad].select(F.lit(1).alias("n")).unionAll(quedan[entidad].select(F.lit(-1).alias("n")))
        fila = n.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("eliminados"))
        fila = fila.select(F.lit(entidad).alias("entidad"), "eliminados")
        resumen = fila if resumen is None else resumen.unionAll(fila)
    return quedan, resumen


def pull_products(pedido: DataFrame, productos: DataFrame) -> DataFrame:
    """Drop the lines of deleted products from the ``detalles`` of every order."""
    borrados = (
        pedido.select("id_pedido", F.explode("detalles.id_producto").alias("id_producto"))
        .join(productos, "id_producto", "left_semi")
        .groupBy("id_pedido")
        .agg(F.collect_set("id_producto").alias("_borrados"))
    )
    limpio = F.filter("detalles", lambda d: ~F.array_contains("_borrados", d.id_producto))
    return (
        pedido.join(borrados, "id_pedido", "left")
        .withColumn("detalles", F.when(F.col("_borrados").isNull(), F.col("detalles")).otherwise(limpio))
        .drop("_borrados")
    )


def enforce_fk(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Referential clean-up: a missing referrer or driver becomes NULL, other missing parents cascade.

    ``tables``: usuario, restaurante, repartidor, menu, producto, reserva, pedido, detalle.
    """

    def set_null(df: DataFrame, col: str, padre: DataFrame, clave: str) -> DataFrame:
        vivos = padre.select(F.col(clave).alias(col), F.lit(True).alias("_vivo")).distinct()
        return (
            df.join(vivos, col, "left")
            .withColumn(col, F.when(F.col("_vivo"), F.col(col)))
            .select(*df.columns)
        )

    def cascada(df: DataFrame, col: str, padre: DataFrame, clave: str | None = None) -> DataFrame:
        return df.join(padre.select(F.col(clave or col).alias(col)), col, "left_semi").select(*df.columns)

    t = dict(tables)
    t["usuario"] = set_null(t["usuario"], "id_referido", t["usuario"], "id_usuario")
    t["restaurante"] = cascada(t["restaurante"], "id_admin", t["usuario"], "id_usuario")
    t["menu"] = cascada(t["menu"], "id_restaurante", t["restaurante"])
    t["producto"] = cascada(t["producto"], "id_menu", t["menu"])
    for entidad in ("reserva", "pedido"):
        t[entidad] = cascada(cascada(t[entidad], "id_usuario", t["usuario"]), "id_restaurante", t["restaurante"])
    t["pedido"] = set_null(t["pedido"], "id_repartidor", t["repartidor"], "id_repartidor")
    t["detalle"] = cascada(cascada(t["detalle"], "id_pedido", t["pedido"]), "id_producto", t["producto"])
    return t


def _fuera(col: str, *validos: str) -> Column:
    return F.coalesce(~F.col(col).isin(*validos), F.lit(True))


def _coordenadas(lat: str, lng: str) -> Column:
    return ~F.col(lat).between(-90, 90) | ~F.col(lng).between(-180, 180)




def _reglas() -> dict[str, dict[str, Column]]:
    return {
        "usuario": {"rol_invalido": _fuera("rol", "cliente", "administrador"),
                    "coordenadas_fuera_de_rango": _coordenadas("latitud", "longitud")},
        "restaurante": {"coordenadas_fuera_de_rango": _coordenadas("latitud", "longitud")},
        "repartidor": {"estado_invalido": ~F.col("estado").isin("disponible", "ocupado", "desconectado"),
                       "coordenadas_fuera_de_rango": _coordenadas("latitud_actual", "longitud_actual")},
        "producto": {"precio_negativo": F.coalesce(F.col("precio") < 0, F.lit(True))},
        "reserva": {"estado_invalido": _fuera("estado", "pendiente", "confirmada", "cancelada")},
        "pedido": {"estado_invalido": _fuera("estado", "pendiente", "en preparacion", "listo", "entregado"),
                   "tipo_invalido": _fuera("tipo", "en restaurante", "para recoger")},
        "detalle": {"cantidad_no_positiva": F.coalesce(F.col("cantidad") <= 0, F.lit(True)),
                    "subtotal_negativo": F.coalesce(F.col("subtotal") < 0, F.lit(True))},
    }


UNICOS = {"usuario": {"email_repetido": "email"}}


def quality_violations(df: DataFrame, kind: str) -> DataFrame:
    """(regla, filas): rows of one entity that break each rule, rules without violations included.

    Every row of a repeated unique value counts as a violation; repeats are counted by value, so a very
    frequent one is summed before it is shuffled.
    """
    reglas = _reglas()[kind]
    conteos = df.agg(*[F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).alias(n) for n, c in reglas.items()])
    pares = ", ".join(f"'{n}', `{n}`" for n in reglas)
    salida = conteos.selectExpr(f"stack({len(reglas)}, {pares}) as (regla, filas)")
    for nombre, col in UNICOS.get(kind, {}).items():
        repetidos = df.filter(F.col(col).isNotNull()).groupBy(col).count().filter("count > 1")
        salida = salida.unionAll(
            repetidos.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("filas")).select(F.lit(nombre).alias("regla"), "filas")
        )
    return salida


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    reporte = None
    for kind in _reglas():
        if kind in tables:
            filas = quality_violations(tables[kind], kind).select(F.lit(kind).alias("entidad"), "regla", "filas")
            reporte = filas if reporte is None else reporte.unionAll(filas)
    return reporte

