"""Aggregate expressions and the fact-by-time rollup used by cubes, report and dashboard.

Money is DECIMAL in the facts: sums are exact and do not depend on the order of the rows; results are
cast to double at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fogon.functions.calendar import atributos_tiempo
from fogon.schemas import PARTICIONES


def uno_si(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def doble(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def razon(num: Column | str, den: Column | str) -> Column:
    """num / den in double, NULL when den is 0 or NULL."""
    return F.try_divide(doble(num), doble(den))


def pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    return F.round(F.try_divide(doble(num) * 100.0, doble(den)), digits)


def o_cero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def crecimiento(actual: str, anterior: str) -> Column:
    """Percent change, NULL without a positive predecessor."""
    a, b = doble(actual), doble(anterior)
    return F.when(b > 0, F.round((a - b) * 100.0 / b, 2))


def conteos(col: str, valores: dict[str, str]) -> dict[str, Column]:
    """One 0/1 measure per output name, set where ``col`` holds the given value."""
    return {nombre: uno_si(F.col(col) == valor) for nombre, valor in valores.items()}


ESTADOS = {"pedidos_entregados": "entregado", "pedidos_pendientes": "pendiente",
           "pedidos_preparacion": "en preparacion", "pedidos_listos": "listo"}
TIPOS = {"pedidos_restaurante": "en restaurante", "pedidos_recoger": "para recoger"}
# Attributes of a minute that follow from its day; year and month are columns of the facts.
DEL_DIA = {"fecha", "dia", "trimestre", "dia_semana", "es_fin_semana"}


def por_tiempo(
    hechos: DataFrame,
    llaves: list[str],
    llaves_tiempo: list[str],
    sumas: dict[str, Column],
    distintos: dict[str, Column] | None = None,
    distintos_tiempo: dict[str, str] | None = None,
) -> DataFrame:
    """Group facts by their own keys and by attributes of their minute.

    ``sumas`` are additive measures; ``distintos`` and ``distintos_tiempo`` are distinct counts over fact
    expressions and over attributes of the minute. The load gives every fact a minute of the time dimension, and the
    id of a minute is a point in time within it, so all of its attributes follow from the fact's own ``tiempo_id``; year
    and month are the partition columns, so a filter on them prunes. Sums and distinct counts are aggregates of their own
    over the columns they need, so no sum is multiplied and shuffled along with a distinct value; their results, one row a
    group each, are gathered at the end. Attributes that follow from the day are added to the results.
    A fact without a minute is left out.
    """
    distintos, distintos_tiempo = distintos or {}, distintos_tiempo or {}
    atributos = atributos_tiempo(F.col("tiempo_id"))
    del_dia = [c for c in llaves_tiempo if c in DEL_DIA] if "fecha" in llaves_tiempo else []
    claves = {c: F.col(c) if c in PARTICIONES else atributos[c] for c in llaves_tiempo if c not in del_dia}
    if del_dia:
        claves["_dia"] = F.floor(F.col("tiempo_id") / 86400)
    grupo = [*llaves, *claves]
    valores = {**distintos, **{n: F.col(c) if c in PARTICIONES else atributos[c] for n, c in distintos_tiempo.items()}}
    filas = hechos.filter(F.col("tiempo_id").isNotNull())

    def por_grupo(columnas: dict[str, Column]) -> DataFrame:
        return filas.select(*llaves, *[c.alias(n) for n, c in claves.items()], *[c.alias(f"_m_{n}") for n, c in columnas.items()])

    junto = por_grupo(sumas).groupBy(*grupo).agg(*[F.sum(f"_m_{n}").alias(n) for n in sumas])
    if valores:
        cuentas = por_grupo(valores).groupBy(*grupo).agg(*[F.count_distinct(f"_m_{n}").alias(n) for n in valores])
        # One side holds a measure of a group, the other has null there.
        junto = junto.unionByName(cuentas, allowMissingColumns=True).groupBy(*grupo).agg(*[F.max(n).alias(n) for n in [*sumas, *valores]])
    a_medianoche = atributos_tiempo(F.col("_dia") * 86400) if del_dia else {}
    return junto.select(
        *llaves, *[a_medianoche[c].alias(c) if c in del_dia else F.col(c) for c in llaves_tiempo], *sumas, *valores
    )
