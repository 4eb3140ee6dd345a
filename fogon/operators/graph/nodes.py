"""Node and edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fogon.functions.sizing import never_broadcast

CLAVES_NODO = {
    "Usuario": "id_usuario",
    "Producto": "id_producto",
    "Pedido": "id_pedido",
    "Restaurante": "id_restaurante",
    "Repartidor": "id_repartidor",
}
PROPIEDADES = {
    "Usuario": ["nombre", "latitud", "longitud", "id_referido"],
    "Producto": ["nombre", "categoria", "precio"],
    "Pedido": ["estado", "tipo"],
    "Restaurante": ["nombre", "latitud", "longitud"],
    "Repartidor": ["nombre", "latitud_actual", "longitud_actual"],
}


def nodes(label: str, df: DataFrame) -> DataFrame:
    """Node rows of one label; ``df`` carries ``source_db``. A user without coordinates is placed at 0, 0."""
    filas = df.select(CLAVES_NODO[label], "source_db", *PROPIEDADES[label])
    if label == "Usuario":
        filas = filas.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("latitud", "longitud")})
    return filas


def merge_nodes(label: str, new: DataFrame, old: DataFrame) -> DataFrame:
    """Upsert by (id, source_db): the row updated last wins, and of equal times the new one.

    Both inputs carry ``updated_at``. The latest row is an aggregate, so repeated updates of one node are
    reduced before the shuffle.
    """
    clave = [CLAVES_NODO[label], "source_db"]
    resto = [c for c in old.columns if c not in clave]
    todas = new.select(*clave, *resto, F.lit(1).alias("_nuevo")).unionByName(
        old.select(*clave, *resto, F.lit(0).alias("_nuevo"))
    )
    fila = F.struct(*resto)
    ultima = F.max_by(fila, F.struct("updated_at", "_nuevo", fila)).alias("_f")
    return todas.groupBy(*clave).agg(ultima).select(*clave, "_f.*")


def _with_end(rows: DataFrame, end: DataFrame, clave: str) -> DataFrame:
    """Rows whose ``clave`` is a node of ``end`` in the same source. Nodes are as many as the data has, so they are shuffled with the rows."""
    return rows.join(never_broadcast(end), [clave, "source_db"], "left_semi")


def edges_contiene(lines: DataFrame, pedidos: DataFrame, productos: DataFrame) -> DataFrame:
    """Order → product with the quantity of the last line; both ends must exist in the same source.

    Lines meet their order first: the shuffle by order serves the quantities as well.
    """
    ultima = F.max_by("cantidad", F.struct("id_detalle", "cantidad")).alias("cantidad")
    por_producto = _with_end(lines, pedidos, "id_pedido").groupBy("id_pedido", "id_producto", "source_db").agg(ultima)
    return _with_end(por_producto, productos, "id_producto").select("id_pedido", "id_producto", "source_db", "cantidad")


def _edges_from_orders(orders: DataFrame, pedidos: DataFrame, otros: DataFrame, clave: str) -> DataFrame:
    filas = orders.filter(F.col(clave).isNotNull()).select("id_pedido", clave, "source_db")
    return _with_end(_with_end(filas, pedidos, "id_pedido").distinct(), otros, clave).select("id_pedido", clave, "source_db")


def edges_proviene(orders: DataFrame, pedidos: DataFrame, restaurantes: DataFrame) -> DataFrame:
    return _edges_from_orders(orders, pedidos, restaurantes, "id_restaurante")


def edges_pertenece(orders: DataFrame, pedidos: DataFrame, usuarios: DataFrame) -> DataFrame:
    return _edges_from_orders(orders, pedidos, usuarios, "id_usuario")


def edges_asignado(orders: DataFrame, pedidos: DataFrame, repartidores: DataFrame) -> DataFrame:
    return _edges_from_orders(orders, pedidos, repartidores, "id_repartidor")


def edges_refiere(users: DataFrame) -> DataFrame:
    """Referrer → referred; the referrer must be a user of the same source."""
    aristas = users.filter(F.col("id_referido").isNotNull()).select(
        F.col("id_referido").alias("id_referente"), F.col("id_usuario").alias("id_referido"), "source_db"
    )
    referentes = users.select(F.col("id_usuario").alias("id_referente"), "source_db")
    return _with_end(aristas, referentes, "id_referente").distinct().select(
        "id_referente", "id_referido", "source_db"
    )


def sync_counts(productos: DataFrame, pedidos: DataFrame, lineas: DataFrame) -> DataFrame:
    """Products, orders and order lines synchronised per source."""
    nombres = {"productos_sincronizados": productos, "pedidos_sincronizados": pedidos, "relaciones_creadas": lineas}
    partes = [
        df.groupBy("source_db").agg(F.count(F.lit(1)).alias("n")).select("source_db", F.lit(nombre).alias("que"), "n")
        for nombre, df in nombres.items()
    ]
    todas = partes[0].unionAll(partes[1]).unionAll(partes[2])
    return todas.groupBy("source_db").agg(
        *[F.coalesce(F.sum(F.when(F.col("que") == nombre, F.col("n"))), F.lit(0)).alias(nombre) for nombre in nombres]
    )


def node_counts(nodos: dict[str, DataFrame]) -> DataFrame:
    total = None
    for label, df in nodos.items():
        fila = df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(label).alias("label"), "total")
        total = fila if total is None else total.unionAll(fila)
    return total.orderBy(F.desc("total"), "label")


# Edge table → (source label, source id, target label, target id).
EXTREMOS = {
    "CONTIENE": ("Pedido", "id_pedido", "Producto", "id_producto"),
    "COMPRADO_CON": ("Producto", "id_producto1", "Producto", "id_producto2"),
    "REFIERE": ("Usuario", "id_referente", "Usuario", "id_referido"),
    "PROVIENE": ("Pedido", "id_pedido", "Restaurante", "id_restaurante"),
    "PERTENECE": ("Pedido", "id_pedido", "Usuario", "id_usuario"),
    "ASIGNADO": ("Pedido", "id_pedido", "Repartidor", "id_repartidor"),
    "DISTANCIA": ("Restaurante", "id_restaurante", "Repartidor", "id_repartidor"),
    "DISTANCIA_ENTREGA": ("Repartidor", "id_repartidor", "Usuario", "id_usuario"),
}


def all_edges(aristas: dict[str, DataFrame]) -> DataFrame:
    """Every relation as (origen, id_origen, tipo, destino, id_destino, source_db)."""
    total = None
    for tipo, df in aristas.items():
        origen, id_origen, destino, id_destino = EXTREMOS[tipo]
        filas = df.select(
            F.lit(origen).alias("origen"), F.col(id_origen).alias("id_origen"), F.lit(tipo).alias("tipo"),
            F.lit(destino).alias("destino"), F.col(id_destino).alias("id_destino"), "source_db",
        )
        total = filas if total is None else total.unionAll(filas)
    return total
