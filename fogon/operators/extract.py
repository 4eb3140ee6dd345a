"""Extraction from the relational and the document source into one row format.

Rows have the same columns whichever source they come from; ids of the two sources overlap, so every
row carries ``fuente_datos``. An extraction without a cap does not sort: order means nothing to a load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fogon import schemas
from fogon.functions import geo
from fogon.functions.calendar import to_event_ts
from fogon.functions.sizing import broadcast_if_few

COORDENADAS = ["usuario_latitud", "usuario_longitud", "restaurante_latitud", "restaurante_longitud"]
PEDIDO = [
    "id_pedido", "id_usuario", "id_restaurante", "id_repartidor", "fecha_hora", "estado", "tipo",
    "total_pedido", "cantidad_items", *COORDENADAS,
]
ZONAS = {"zona_cliente": "usuario", "zona_restaurante": "restaurante"}
RESERVA = ["id_reserva", "id_usuario", "id_restaurante", "fecha_hora", "estado"]
DETALLE = [
    "id_pedido", "id_producto", "cantidad", "subtotal", "precio_unitario", "nombre_producto",
    "categoria_producto", "precio_producto", "id_menu", "fecha_hora", "id_usuario", "id_restaurante",
    "id_repartidor", "estado_pedido", "tipo_pedido", *COORDENADAS,
]


def _coords(df: DataFrame, clave: str, prefijo: str) -> DataFrame:
    return df.select(
        clave, F.col("latitud").alias(f"{prefijo}_latitud"), F.col("longitud").alias(f"{prefijo}_longitud")
    )


def _one_per_key(df: DataFrame, clave: str) -> DataFrame:
    """A lookup takes one document per key; which one is fixed (the smallest) so that reruns agree."""
    resto = [c for c in df.columns if c != clave]
    return df.groupBy(clave).agg(F.min(F.struct(*resto)).alias("_doc")).select(clave, "_doc.*")


def with_zones(df: DataFrame, prefijos: list[str]) -> DataFrame:
    """Add the numbers of the provinces (``geo.zona``) that hold the coordinates of the given prefixes."""
    return df.withColumns({z: geo.zona(F.col(f"{p}_latitud"), F.col(f"{p}_longitud")) for z, p in ZONAS.items() if p in prefijos})


def _zones() -> list[Column]:
    """Numbers of the provinces of rows joined with places; rows that found no place are nowhere."""
    return [F.coalesce(z, F.lit(len(geo.ZONAS)).cast("byte")).alias(z) for z in ZONAS]


def _newest(df: DataFrame, limit: int | None, *desempate: str) -> DataFrame:
    return df if limit is None else df.orderBy(F.desc("fecha_hora"), *desempate).limit(limit)


def extract_pedidos_rel(
    pedido: DataFrame, detalle: DataFrame, usuario: DataFrame, restaurante: DataFrame, limit: int | None = None
) -> DataFrame:
    """Orders with the totals of their lines; lines are summed before the join, so nothing fans out."""
    lineas = detalle.groupBy("id_pedido").agg(
        F.sum(F.col("subtotal").cast(schemas.DINERO)).alias("total_pedido"),
        F.sum("cantidad").alias("cantidad_items"),
    )
    filas = (
        _newest(pedido, limit, "id_pedido")
        .join(lineas, "id_pedido", "left")
        .join(_coords(usuario, "id_usuario", "usuario"), "id_usuario", "left")
        .join(_coords(restaurante, "id_restaurante", "restaurante"), "id_restaurante", "left")
    )
    return require_timestamp(normalize_extract(filas.select(*PEDIDO), "relational"))


def extract_pedidos_doc(pedidos: DataFrame, usuarios: DataFrame, restaurantes: DataFrame) -> DataFrame:
    """Orders whose totals come from the embedded array of lines."""

    def total(campo: str, tipo: str) -> Column:
        return F.aggregate(
            F.coalesce("detalles", F.expr("array()")),
            F.lit(0).cast(tipo),
            lambda suma, linea: (suma + F.coalesce(linea[campo].cast(tipo), F.lit(0).cast(tipo))).cast(tipo),
        )

    filas = (
        pedidos.withColumn("total_pedido", total("subtotal", "decimal(20,2)"))
        .withColumn("cantidad_items", total("cantidad", "bigint"))
        .drop("detalles")
        .join(_one_per_key(_coords(usuarios, "id_usuario", "usuario"), "id_usuario"), "id_usuario", "left")
        .join(_one_per_key(_coords(restaurantes, "id_restaurante", "restaurante"), "id_restaurante"),
              "id_restaurante", "left")
    )
    return require_timestamp(normalize_extract(filas.select(*PEDIDO), "document"))


def extract_reservas_rel(reserva: DataFrame, limit: int | None = None) -> DataFrame:
    filas = _newest(reserva.select(*RESERVA), limit, "id_reserva")
    return require_timestamp(normalize_extract(filas, "relational"))


def extract_reservas_doc(reservas: DataFrame) -> DataFrame:
    return require_timestamp(normalize_extract(reservas.select(*RESERVA), "document"))


def _line_columns(zonas: bool) -> list[Column | str]:
    return [*[c for c in DETALLE if c not in COORDENADAS], *_zones()] if zonas else [*DETALLE]


def extract_detalle_rel(
    detalle: DataFrame,
    pedido: DataFrame,
    producto: DataFrame,
    menu: DataFrame,
    restaurante: DataFrame,
    usuario: DataFrame,
    limit: int | None = None,
    zonas: bool = False,
) -> DataFrame:
    """Order lines with product, order and coordinates, or with ``zonas`` in their place; the unit price is the catalog price."""
    catalogo = producto.join(menu.select("id_menu"), "id_menu").select(
        "id_producto",
        F.col("precio").alias("precio_unitario"),
        F.col("nombre").alias("nombre_producto"),
        F.col("categoria").alias("categoria_producto"),
        F.col("precio").alias("precio_producto"),
        "id_menu",
    )
    contexto = (
        pedido.join(with_zones(_coords(restaurante, "id_restaurante", "restaurante"), ["restaurante"]), "id_restaurante")
        .join(with_zones(_coords(usuario, "id_usuario", "usuario"), ["usuario"]), "id_usuario", "left")
        .withColumnsRenamed({"estado": "estado_pedido", "tipo": "tipo_pedido"})
    )
    filas = (
        detalle.select("id_pedido", "id_producto", "cantidad", "subtotal")
        .join(contexto, "id_pedido")
        .join(broadcast_if_few(catalogo), "id_producto")
    )
    filas = _newest(filas.select(*_line_columns(zonas)), limit, "id_pedido", "id_producto")
    return require_timestamp(normalize_extract(filas, "relational"))


def extract_detalle_doc(
    pedidos: DataFrame, productos: DataFrame, usuarios: DataFrame, restaurantes: DataFrame, zonas: bool = False
) -> DataFrame:
    """Unwound order lines; the unit price is subtotal / cantidad, 0 where cantidad is not positive."""
    catalogo = productos.select(
        "id_producto",
        F.col("nombre").alias("nombre_producto"),
        F.col("categoria").alias("categoria_producto"),
        F.nullif(F.col("precio"), F.lit(0.0)).alias("precio_producto"),
        "id_menu",
    )
    contexto = (
        pedidos.join(with_zones(_one_per_key(_coords(usuarios, "id_usuario", "usuario"), "id_usuario"), ["usuario"]), "id_usuario", "left")
        .join(with_zones(_one_per_key(_coords(restaurantes, "id_restaurante", "restaurante"), "id_restaurante"), ["restaurante"]),
              "id_restaurante", "left")
        .withColumnsRenamed({"estado": "estado_pedido", "tipo": "tipo_pedido"})
    )
    lineas = contexto.select("*", F.inline("detalles")).drop("detalles")
    filas = (
        lineas.join(_one_per_key(catalogo, "id_producto"), "id_producto", "left")
        .withColumn(
            "precio_unitario", F.when(F.col("cantidad") > 0, F.col("subtotal") / F.col("cantidad")).otherwise(0.0)
        )
    )
    return require_timestamp(normalize_extract(filas.select(*_line_columns(zonas)), "document"))


# Defaults for missing texts of the relational source.
TEXTOS_POR_DEFECTO = {
    "estado": "unknown",
    "tipo": "unknown",
    "estado_pedido": "unknown",
    "tipo_pedido": "unknown",
    "nombre_producto": "Producto sin nombre",
    "categoria_producto": "Sin categoría",
}
MEDIDAS = {"total_pedido": "double", "cantidad_items": "bigint", "cantidad": "int", "subtotal": "double",
           "precio_unitario": "double"}


def normalize_extract(df: DataFrame, kind: str) -> DataFrame:
    """Types and defaults of extracted rows; ``kind`` is ``relational`` or ``document``.

    Missing measures become 0 in both. Missing or empty texts (and a missing product price) get their
    default only in the relational source; documents keep what they hold.
    """
    nuevas: dict[str, Column] = {}
    for c in df.columns:
        if c in MEDIDAS:
            nuevas[c] = F.coalesce(F.col(c).cast(MEDIDAS[c]), F.lit(0).cast(MEDIDAS[c]))
        elif c in COORDENADAS or c == "precio_producto":
            nuevas[c] = F.col(c).cast("double")
        elif c == "fecha_hora":
            nuevas[c] = F.col(c) if dict(df.dtypes)[c] == "timestamp_ntz" else to_event_ts(F.col(c))
    if kind == "relational":
        for c, defecto in TEXTOS_POR_DEFECTO.items():
            if c in df.columns:
                nuevas[c] = F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(defecto))
        if "precio_producto" in nuevas:
            nuevas["precio_producto"] = F.coalesce(nuevas["precio_producto"], F.lit(0.0))
    return df.withColumns(nuevas)


def require_timestamp(df: DataFrame) -> DataFrame:
    return df.filter(F.col("fecha_hora").isNotNull())


def union_sources(**por_fuente: DataFrame) -> DataFrame:
    """Union of the sources' rows, each tagged with the name of its source."""
    marcadas = [df.withColumn("fuente_datos", F.lit(nombre)) for nombre, df in por_fuente.items()]
    union = marcadas[0]
    for df in marcadas[1:]:
        union = union.unionByName(df)
    return union
