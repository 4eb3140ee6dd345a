"""Products bought together: pair frequency, support and confidence, and the reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fogon.functions.measures import o_cero, pct
from fogon.functions.pairs import BLOQUE, pairs_within
from fogon.functions.sizing import broadcast_if_few, never_broadcast

def copurchase(contiene: DataFrame, pedidos: DataFrame, bloque: int = BLOQUE) -> DataFrame:
    """COMPRADO_CON edges: one row per direction, computed inside each source.

    ``contiene`` holds an order's product once, as ``edges_contiene`` makes it; give it as a written table,
    since it is read several times.
    support = orders with both / all orders of the source; confidence = orders with both / orders with the
    first product.
    """
    lineas = contiene.select("source_db", "id_pedido", "id_producto")
    ventas = lineas.groupBy("source_db", "id_producto").agg(F.count(F.lit(1)).alias("total"))
    # Totals go into the baskets: there are fewer lines than pairs, and the pairs need no joins then.
    cestas = lineas.join(ventas, ["source_db", "id_producto"])
    pares_por_pedido = pairs_within(cestas, ["source_db", "id_pedido"], "id_producto", bloque)
    # One row per source: safe to broadcast.
    totales = F.broadcast(pedidos.groupBy("source_db").agg(F.count(F.lit(1)).alias("total_pedidos")))
    pares = (
        pares_por_pedido.groupBy("source_db", "id_producto1", "id_producto2")
        .agg(F.count(F.lit(1)).alias("frecuencia"), *[F.max(f"total{i}").alias(f"total{i}") for i in (1, 2)])
        .join(totales, "source_db")
    )
    frecuencia = F.col("frecuencia")
    direcciones = [
        F.struct(
            F.col(f"id_producto{a}").alias("id_producto1"), F.col(f"id_producto{b}").alias("id_producto2"),
            (frecuencia / F.col(f"total{a}")).alias("confidence"),
        )
        for a, b in ((1, 2), (2, 1))
    ]
    return pares.select(
        "source_db", "frecuencia", (frecuencia / F.col("total_pedidos")).alias("support"), F.inline(F.array(*direcciones))
    ).select("id_producto1", "id_producto2", "source_db", "frecuencia", "support", "confidence")


def _named(aristas: DataFrame, productos: DataFrame, *campos: str) -> DataFrame:
    """Product properties of both ends, as ``<campo>1`` and ``<campo>2``."""
    for i in (1, 2):
        lado = productos.select(
            F.col("id_producto").alias(f"id_producto{i}"), "source_db", *[F.col(c).alias(f"{c}{i}") for c in campos]
        )
        aristas = aristas.join(lado, [f"id_producto{i}", "source_db"])
    return aristas


def _in_sources(df: DataFrame, sources: list[str] | None) -> DataFrame:
    return df if sources is None else df.filter(F.col("source_db").isin(sources))


IDS = ["id_producto1", "id_producto2", "source_db"]


def _una_direccion() -> Column:
    return F.col("id_producto1") < F.col("id_producto2")


def top_copurchase_pairs(aristas: DataFrame, productos: DataFrame, source: str, n: int = 5) -> DataFrame:
    """Most frequent pairs with the confidence of both directions; the top is cut before the joins."""
    de_fuente = aristas.filter(F.col("source_db") == source)
    top = de_fuente.filter(_una_direccion()).orderBy(F.desc("frecuencia"), F.desc("support"), *IDS).limit(n)
    vuelta = de_fuente.select(
        F.col("id_producto2").alias("id_producto1"), F.col("id_producto1").alias("id_producto2"), "source_db",
        F.col("confidence").alias("vuelta"),
    )
    return (
        _named(vuelta.join(top, IDS), productos, "nombre")
        .orderBy(F.desc("frecuencia"), F.desc("support"), *IDS)
        .select(
            F.col("nombre1").alias("producto1"), F.col("nombre2").alias("producto2"), "frecuencia",
            F.round("support", 4).alias("support"), F.round("confidence", 4).alias("confidence_p1_to_p2"),
            F.round("vuelta", 4).alias("confidence_p2_to_p1"),
        )
    )


def top_copurchases(aristas: DataFrame, productos: DataFrame, sources: list[str] | None = None, limit: int = 20) -> DataFrame:
    top = (
        _in_sources(aristas, sources).filter(_una_direccion())
        .orderBy(F.desc("frecuencia"), F.desc("support"), *IDS).limit(limit)
    )
    return (
        _named(top, productos, "nombre", "categoria")
        .orderBy(F.desc("frecuencia"), F.desc("support"), *IDS)
        .select(
            F.col("nombre1").alias("producto1"), F.col("nombre2").alias("producto2"),
            F.col("categoria1"), F.col("categoria2"), F.col("source_db").alias("fuente_datos"), "frecuencia", "support",
            F.col("confidence").alias("confidence_p1_to_p2"),
        )
    )


def pair_labels(top: DataFrame) -> DataFrame:
    return top.withColumn("par_productos", F.concat_ws(" + ", "producto1", "producto2"))


def copurchase_metrics(aristas: DataFrame, productos: DataFrame, sources: list[str] | None = None) -> DataFrame:
    total = _in_sources(productos, sources).agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        _in_sources(aristas, sources)
        .agg(
            F.count(F.lit(1)).alias("total_relaciones_copurchase"),
            F.count_distinct(F.struct("id_producto1", "source_db")).alias("productos_con_copurchases"),
            F.round(o_cero(F.avg("frecuencia")), 6).alias("frecuencia_promedio"),
            F.coalesce(F.max("frecuencia"), F.lit(0)).alias("frecuencia_maxima"),
            F.round(o_cero(F.avg("support")), 8).alias("support_promedio"),
            o_cero(F.max("support")).alias("support_maximo"),
        )
        .select(total.alias("total_productos"), "*")
    )


def copurchase_coverage(metrics: DataFrame) -> DataFrame:
    return metrics.select(o_cero(pct("productos_con_copurchases", "total_productos")).alias("cobertura_pct"))


def _nivel(etiquetas: tuple[str, str, str, str]) -> Column:
    c = F.col("confidence")
    return F.when(c >= 0.7, etiquetas[0]).when(c >= 0.5, etiquetas[1]).when(c >= 0.3, etiquetas[2]).otherwise(etiquetas[3])


# Labels by confidence.
FUERZA = ("Muy Alta", "Alta", "Media", "Baja")
RECOMENDACION = ("Muy recomendado", "Recomendado", "Moderadamente recomendado", "Débilmente recomendado")


def strong_relations(
    aristas: DataFrame, productos: DataFrame, min_conf: float = 0.3, limit: int = 15, sources: list[str] | None = None
) -> DataFrame:
    orden = [F.desc("confidence"), F.desc("frecuencia"), *IDS]
    top = _in_sources(aristas, sources).filter(F.col("confidence") >= min_conf).orderBy(*orden).limit(limit)
    return (
        _named(top, productos, "nombre", "categoria").orderBy(*orden)
        .select(
            F.col("nombre1").alias("producto_origen"), F.col("nombre2").alias("producto_destino"),
            F.col("categoria1").alias("categoria_origen"), F.col("categoria2").alias("categoria_destino"),
            F.col("source_db").alias("fuente_datos"), "frecuencia", "support", "confidence",
            _nivel(FUERZA).alias("fuerza_relacion"),
        )
    )


def recommend(
    aristas: DataFrame, productos: DataFrame, name: str, limit: int = 5, sources: list[str] | None = None
) -> DataFrame:
    """Products bought with those whose name contains ``name``; the name filter runs on the product table."""
    base = broadcast_if_few(productos.filter(F.contains("nombre", F.lit(name))).select(F.col("id_producto").alias("id_producto1"), "source_db"))
    orden = [F.desc("confidence"), F.desc("frecuencia"), *IDS]
    top = (
        _in_sources(aristas, sources).join(base, ["id_producto1", "source_db"], "left_semi").orderBy(*orden).limit(limit)
    )
    return (
        _named(top, productos, "nombre", "categoria").orderBy(*orden)
        .select(
            F.col("nombre1").alias("producto_base"), F.col("nombre2").alias("producto_recomendado"),
            F.col("categoria2").alias("categoria_recomendado"), F.col("source_db").alias("fuente_datos"), "frecuencia",
            "support", "confidence", _nivel(RECOMENDACION).alias("nivel_recomendacion"),
        )
    )


def recommend_summary(recomendaciones: DataFrame) -> DataFrame:
    """Best recommendation, mean confidence and most frequent category of a recommendation list."""
    mejor = F.struct(-F.col("confidence"), -F.col("frecuencia"), F.col("producto_recomendado"))
    categoria = (
        recomendaciones.groupBy("categoria_recomendado").agg(F.count(F.lit(1)).alias("n"))
        .agg(F.min_by("categoria_recomendado", F.struct(-F.col("n"), F.col("categoria_recomendado"))).alias("c"))
        .scalar()
    )
    return recomendaciones.agg(
        F.min_by("producto_recomendado", mejor).alias("mejor_recomendacion"),
        F.max("confidence").alias("mejor_confidence"),
        F.round(F.avg("confidence"), 6).alias("confidence_promedio"),
        F.count(F.lit(1)).alias("total_recomendaciones"),
    ).select("*", categoria.alias("categoria_mas_recomendada"))


def product_pick_list(top: DataFrame) -> DataFrame:
    """Sorted distinct product names of a list of pairs."""
    return (
        top.select(F.col("producto1").alias("producto")).unionAll(top.select(F.col("producto2").alias("producto")))
        .distinct().orderBy("producto")
    )


def combos_by_price(aristas: DataFrame, productos: DataFrame, n: int = 5, sources: list[str] | None = None) -> DataFrame:
    """Pairs by the mean of the summed price."""
    juntos = _named(_in_sources(aristas, sources).filter(_una_direccion()), never_broadcast(productos), "nombre", "categoria", "precio")
    return (
        juntos.groupBy("nombre1", "nombre2", "categoria1", "categoria2")
        .agg(F.round(F.avg(F.col("precio1") + F.col("precio2")), 4).alias("precio_promedio_combo"))
        .orderBy(F.desc("precio_promedio_combo"), "nombre1", "nombre2", "categoria1", "categoria2")
        .limit(n)
        .select(F.col("nombre1").alias("producto1"), F.col("nombre2").alias("producto2"), "categoria1", "categoria2",
                "precio_promedio_combo")
    )


def copurchase_network(aristas: DataFrame, min_freq: int = 2, sources: list[str] | None = None) -> DataFrame:
    return _in_sources(aristas, sources).filter(F.col("frecuencia") >= min_freq)
