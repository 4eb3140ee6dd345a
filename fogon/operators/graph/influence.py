"""Referral influence of users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fogon.functions.measures import o_cero, pct


def _in_sources(df: DataFrame, sources: list[str] | None) -> DataFrame:
    return df if sources is None else df.filter(F.col("source_db").isin(sources))


def _with_referrals(usuarios: DataFrame, refiere: DataFrame, sources: list[str] | None) -> DataFrame:
    """Users with the number of users they referred, 0 included."""
    conteo = _in_sources(refiere, sources).groupBy(F.col("id_referente").alias("id_usuario"), "source_db").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        _in_sources(usuarios, sources).join(conteo, ["id_usuario", "source_db"], "left")
        .withColumn("total_referidos", F.coalesce("n", F.lit(0))).drop("n")
    )


def _nivel() -> Column:
    n = F.col("total_referidos")
    return F.when(n > 5, "Alto").when(n > 2, "Medio").when(n > 0, "Bajo").otherwise("Sin referidos")


NIVELES = ["Alto", "Medio", "Bajo", "Sin referidos"]


def top_influencers(usuarios: DataFrame, refiere: DataFrame, source: str, n: int = 5) -> DataFrame:
    return (
        _with_referrals(usuarios, refiere, [source])
        .select("id_usuario", "nombre", "total_referidos")
        .orderBy(F.desc("total_referidos"), "id_usuario").limit(n)
    )


def influence_network(
    usuarios: DataFrame, refiere: DataFrame, sources: list[str] | None = None, limit: int | None = 20
) -> DataFrame:
    red = (
        _with_referrals(usuarios, refiere, sources)
        .select("id_usuario", "nombre", F.col("source_db").alias("fuente_datos"), "total_referidos",
                _nivel().alias("nivel_influencia"))
        .orderBy(F.desc("total_referidos"), "id_usuario", "fuente_datos")
    )
    return red if limit is None else red.limit(limit)


def influence_metrics(usuarios: DataFrame, refiere: DataFrame, sources: list[str] | None = None) -> DataFrame:
    n = F.col("total_referidos")
    return _with_referrals(usuarios, refiere, sources).agg(
        F.count(F.lit(1)).alias("total_usuarios"),
        F.count(F.when(n > 0, 1)).alias("usuarios_con_referidos"),
        o_cero(F.try_divide(F.sum(n).cast("double"), F.count(F.lit(1)).cast("double"))).alias("promedio_referidos_por_usuario"),
        F.coalesce(F.max(n), F.lit(0)).alias("max_referidos"),
        F.coalesce(F.sum(n), F.lit(0)).alias("total_referencias"),
    )


def influence_distribution(usuarios: DataFrame, refiere: DataFrame, sources: list[str] | None = None) -> DataFrame:
    por_nivel = (
        _with_referrals(usuarios, refiere, sources).groupBy(_nivel().alias("nivel_influencia"))
        .agg(F.count(F.lit(1)).alias("cantidad_usuarios"))
    )
    total = por_nivel.agg(F.sum("cantidad_usuarios")).scalar()
    return (
        por_nivel.withColumn("porcentaje", pct(F.col("cantidad_usuarios"), total))
        .orderBy(F.array_position(F.array(*map(F.lit, NIVELES)), F.col("nivel_influencia")))
    )


def engagement(metrics: DataFrame) -> DataFrame:
    return metrics.select(o_cero(pct("usuarios_con_referidos", "total_usuarios")).alias("tasa_engagement_pct"))


def influencers_by_zone(usuarios: DataFrame, refiere: DataFrame, source: str, n: int = 10) -> DataFrame:
    """Users who referred others, with their zone: coordinates rounded to a tenth of a degree."""
    return (
        _with_referrals(usuarios, refiere, [source]).filter("total_referidos >= 1")
        .select(
            F.col("nombre").alias("usuario_influyente"), "id_usuario", "total_referidos",
            F.round("latitud", 1).alias("zona_lat"), F.round("longitud", 1).alias("zona_lng"),
            F.format_string("%.2f,%.2f", "latitud", "longitud").alias("ubicacion"),
        )
        .orderBy(F.desc("total_referidos"), "zona_lat", "zona_lng", "id_usuario").limit(n)
    )


def referral_network(
    usuarios: DataFrame, refiere: DataFrame, sources: list[str] | None = None, limit: int | None = None
) -> DataFrame:
    nombres = usuarios.select("id_usuario", "source_db", "nombre")
    red = _in_sources(refiere, sources)
    for lado in ("referente", "referido"):
        red = red.join(
            nombres.withColumnsRenamed({"id_usuario": f"id_{lado}", "nombre": lado}), [f"id_{lado}", "source_db"]
        )
    red = red.select("id_referente", "referente", "id_referido", "referido", "source_db")
    return red if limit is None else red.orderBy("id_referente", "id_referido", "source_db").limit(limit)
