"""Exact k nearest targets for every point, without comparing all pairs.

Points on the sphere become 3-D unit vectors, and a cubic cell needs no care at poles or at the date line. The cells form a tree:
every level is four times finer than the one before, and the tree keeps the cells that hold at least k targets.

1. targets are counted per cell, a row per level that partial sums merge before the shuffle;
2. a point takes the finest cell around it with at least k targets and compares itself with these. The k-th nearest of them
   bounds the distance to every answer;
3. cells at least as wide as that ball meet it in two places per axis at most, so these eight cells (most of them without
   targets) hold every possible answer, and only their targets are compared.

All joins are equi-joins on a cell. A target has a row for each level that points of its group use. Points and targets at one location
are handled once: of the targets at one spot only the k with the smallest ids can be an answer. A point far from all targets has
a wide ball and meets many of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fogon.functions.geo import RADIO_TIERRA_KM, distancia_km
from fogon.functions.sizing import never_broadcast

NIVELES = 12  # sides 4, 1, 1/4 … of the Earth radius; the finest is about 1.5 m
HOLGURA = 1e-7  # of the Earth radius: more than what an arc cosine near 1 is wrong by
EJES = ("x", "y", "z")


def _axes() -> dict[str, Column]:
    """Coordinates of ``_lat``, ``_lng`` from 0 to 2, so that one cell of the first level holds the sphere."""
    lat, lng = F.radians("_lat"), F.radians("_lng")
    return {"x": F.cos(lat) * F.cos(lng) + 1, "y": F.cos(lat) * F.sin(lng) + 1, "z": F.sin(lat) + 1}


def _cell(value: Column, level: Column) -> Column:
    """Number of the cell of a level along one axis."""
    return F.floor(value * F.pow(F.lit(4.0), level - 1)).cast("long")


def _at_levels(df: DataFrame, levels: Column) -> DataFrame:
    """One row per level of the array ``levels``, with the cell (nivel, cx, cy, cz) of the row's coordinates."""
    celdas = F.transform(levels, lambda i: F.struct(i.alias("nivel"), *[_cell(F.col(e), i).alias(f"c{e}") for e in EJES]))
    return df.select("*", F.inline(celdas))


def _all_levels() -> Column:
    return F.sequence(F.lit(0), F.lit(NIVELES))


def tree(targets: DataFrame, group: list[str], k: int) -> DataFrame:
    """(group…, nivel, cx, cy, cz) of the cells with at least k targets, and of those of the first level."""
    celda = [*group, "nivel", "cx", "cy", "cz"]
    cuentas = _at_levels(targets.select(*group, *EJES), _all_levels()).groupBy(*celda).agg(F.count(F.lit(1)).alias("n"))
    return cuentas.filter((F.col("n") >= k) | (F.col("nivel") == 0)).drop("n")


def search_cells(sites: DataFrame) -> DataFrame:
    """``sites`` (with axes, ``nivel`` and the radius ``_r`` of their ball) once per cell that the ball can meet."""
    nivel = F.greatest(F.lit(0), F.least(F.col("nivel"), F.floor(1 - F.log(4.0, F.col("_r") * 2)).cast("int")))
    df = sites.withColumn("nivel", nivel)
    for e in EJES:
        orillas = [_cell(F.col(e) + s * F.col("_r"), F.col("nivel")) for s in (-1, 1)]
        df = df.withColumn(f"c{e}", F.explode(F.sequence(*orillas)))
    return df


def _limit_per(df: DataFrame, group: list[str], k: int, *order: Column | str) -> DataFrame:
    puesto = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("puesto", puesto).filter(F.col("puesto") <= k)


def k_nearest(
    points: DataFrame,
    targets: DataFrame,
    k: int,
    point_at: tuple[str, str],
    target_at: tuple[str, str],
    target_id: str,
    group: list[str],
) -> DataFrame:
    """``points`` joined to their k nearest ``targets`` of the same group.

    Adds ``target_id``, ``distancia_km`` and ``puesto`` (1 = nearest; of equal distances the smaller id).
    Points or targets without coordinates take no part.
    """
    celda = [*group, "nivel", "cx", "cy", "cz"]
    sitio = [*group, "_lat", "_lng"]

    def located(df: DataFrame, at: tuple[str, str]) -> DataFrame:
        df = df.withColumns({"_lat": F.col(at[0]).cast("double"), "_lng": F.col(at[1]).cast("double")})
        return df.filter(F.col("_lat").isNotNull() & F.col("_lng").isNotNull())

    destinos = _limit_per(located(targets, target_at).select(target_id, *sitio), sitio, k, target_id).drop("puesto").withColumns(_axes())
    origenes = located(points, point_at)
    sitios = origenes.select(*sitio).distinct().withColumns(_axes())

    hondos = _at_levels(sitios, _all_levels()).join(tree(destinos, group, k), celda, "left_semi").groupBy(*sitio, *EJES).agg(F.max("nivel").alias("nivel"))
    # A ball is looked up at the level of its point or the one before.
    usados = hondos.groupBy(*group).agg(F.collect_set("nivel").alias("_n"))
    usados = usados.withColumn("_n", F.array_union("_n", F.transform("_n", lambda n: F.greatest(n - 1, F.lit(0)))))
    en_celdas = _at_levels(destinos.join(usados, group), F.col("_n")).select(
        *celda, target_id, F.col("_lat").alias("_dlat"), F.col("_lng").alias("_dlng"))

    def nearest(cells: DataFrame) -> DataFrame:
        km = distancia_km(F.col("_lat"), F.col("_lng"), F.col("_dlat"), F.col("_dlng"))
        return _limit_per(cells.join(en_celdas, celda).withColumn("distancia_km", km), sitio, k, "distancia_km", target_id)

    propias = hondos.withColumns({f"c{e}": _cell(F.col(e), F.col("nivel")) for e in EJES})
    radio = F.sin(F.max("distancia_km") / (2 * RADIO_TIERRA_KM)) * 2 + HOLGURA
    bolas = nearest(propias).groupBy(*sitio, *EJES, "nivel").agg(radio.alias("_r"))
    cercanos = nearest(search_cells(bolas))
    return never_broadcast(origenes).join(cercanos.select(*sitio, target_id, "distancia_km", "puesto"), sitio).drop("_lat", "_lng")
