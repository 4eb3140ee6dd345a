"""Greedy delivery routes: from where a driver is, always to the nearest user left.

A route is sequential, so drivers advance side by side and only a driver's own steps follow each other. A driver with up to POOL stops
is walked in one go. A longer route is walked in rounds over a shrinking table of open stops: the stops are counted by ring
around the driver (rings grow with the distance, and counts are combined before the shuffle), the widest disc that holds at most POOL of them is
taken out, and the driver walks in it for as long as no stop outside can be nearer. What was visited leaves the table,
so a round reads the stops still open, and a task never holds more than POOL stops of a driver.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fogon.functions.geo import RADIO_TIERRA_KM, distancia_km
from fogon.session import shared_dir, ship, size_shuffles

POOL = 20_000  # stops of a driver that meet in one task
EN_ANILLO = 1000  # of a ring that is too full to be taken whole; up to this Spark cuts a top-k before the shuffle
ANILLOS_POR_OCTAVA = 8
HOLGURA_KM = 0.001  # far above the rounding noise of a distance
CONDUCTOR = ["source_db", "id_repartidor"]
PARADA = ["id_usuario", "nombre", "latitud", "longitud"]
VISITA = (
    "source_db string, id_repartidor bigint, id_usuario bigint, nombre string, latitud double, longitud double, fila bigint, "
    "orden int, tramo double, total double, total_paradas bigint, final double"
)


def _km_between(a: tuple[float, float], b: tuple[float, float]) -> float:
    """Distance by the formula of ``distancia_km``; all angles in radians."""
    coseno = math.cos(a[0]) * math.cos(b[0]) * math.cos(b[1] - a[1]) + math.sin(a[0]) * math.sin(b[0])
    return math.acos(max(-1.0, min(1.0, coseno))) * RADIO_TIERRA_KM


def greedy(lats: np.ndarray, lngs: np.ndarray, first: np.ndarray, start: tuple[float, float], radius: float, tied: bool = False) -> tuple[list[int], list[float]]:
    """Stops in the order of a greedy walk, and the legs, for as long as the next stop is certain.

    Stops come in the order in which ties are decided. ``first`` is their distance from ``start``. Every stop that is not
    among them is at least ``radius`` away from ``start``: from a place at distance c, it is at least radius - c away. ``tied``: at
    ``start`` itself all of them come before every other stop.
    """
    a, b = np.radians(lats), np.radians(lngs)
    places = np.stack([np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)], axis=1)
    left, shut = np.arange(len(lats)), np.zeros(len(lats))
    here, there = None, (math.radians(start[0]), math.radians(start[1]))
    order: list[int] = []
    legs: list[float] = []
    gone = 0
    while len(order) < len(lats):
        if here is None:
            at, leg = int(first.argmin()), float(first.min())
        else:
            # The largest cosine decides; of places that agree to 12 digits, the distance and then the order of ties.
            cosine = places @ here + shut
            close = np.flatnonzero(cosine >= cosine.max() - 1e-12).tolist()
            leg, at = min((_km_between(there_now, (a[left[i]], b[left[i]])), i) for i in close)
            if radius < math.inf and not (tied and there_now == there) and leg + _km_between(there, there_now) + HOLGURA_KM >= radius:
                break
        stop = int(left[at])
        order.append(stop)
        legs.append(leg)
        there_now, here = (float(a[stop]), float(b[stop])), places[at].copy()
        shut[at] = -10.0
        gone += 1
        if 2 * gone > len(left):
            own = shut == 0
            left, places, shut, gone = left[own], places[own], shut[own], 0
    return order, legs


def _walk(pool: pa.Table) -> pa.Table:
    """The steps of one driver through a pool of stops. Stops without a position come last, by id, without distances."""
    ids = pool.column("id_usuario")
    column = {c: pool.column(c).to_numpy(zero_copy_only=False) for c in ("latitud", "longitud", "d", "d2", "lat", "lng", "total", "orden", "radio", "lleno", "fila")}
    by_id = np.lexsort((column["fila"], ids.fill_null(np.iinfo(np.int64).max).to_numpy()))
    placed = by_id[~np.isnan(column["d"][by_id].astype(float))]
    lost = by_id[np.isnan(column["d"][by_id].astype(float))]
    radius = float(column["radio"][0]) if pool.column("radio")[0].is_valid else math.inf
    start, begun, total = (column["lat"][0], column["lng"][0]), int(column["orden"][0]), float(column["total"][0])
    order, legs = greedy(column["latitud"][placed], column["longitud"][placed], column["d"][placed], start, radius, bool(column["lleno"][0])) if len(placed) else ([], [])
    rows = placed[order] if order else np.zeros(0, dtype=np.int64)
    # The first leg of a route counts rounded to 2 digits, the following ones unrounded.
    counted = [float(column["d2"][rows[0]]) if i == 0 and not begun else leg for i, leg in enumerate(legs)]
    totals = list(np.cumsum([total, *counted])[1:])
    rows = np.r_[rows, lost] if not math.isfinite(radius) else rows
    none = [None] * (len(rows) - len(order))
    taken = pool.take(pa.array(rows))
    out = {c: taken.column(c) for c in (*CONDUCTOR, *PARADA, "fila")}
    out |= {"orden": pa.array(np.arange(begun + 1, begun + 1 + len(rows)), pa.int32()), "tramo": pa.array([*legs, *none], pa.float64()),
            "total": pa.array([*totals, *none], pa.float64()), "total_paradas": pa.array([pool.num_rows] * len(rows), pa.int64()), "final": pa.array([totals[-1] if totals else None] * len(rows), pa.float64())}
    return pa.table(out)


def _km(lat: str, lng: str, lat_b: str, lng_b: str) -> Column:
    return distancia_km(F.col(lat), F.col(lng), F.col(lat_b), F.col(lng_b))


def _walked(pools: DataFrame) -> DataFrame:
    # Dealt out explicitly: by their bytes the stops would be merged into few tasks, but walking takes time, not room.
    tareas = size_shuffles(pools.sparkSession, 0)
    con_d2 = pools.withColumn("d2", F.round("d", 2)).repartition(tareas, *CONDUCTOR)
    return con_d2.groupBy(*CONDUCTOR).applyInArrow(_walk, VISITA)


def _short(stops: DataFrame) -> DataFrame:
    """Drivers whose stops fit into one pool."""
    return _walked(stops.withColumns({
        "d": _km("latitud_actual", "longitud_actual", "latitud", "longitud"), "lat": F.col("latitud_actual"), "lng": F.col("longitud_actual"),
        "total": F.lit(0.0), "orden": F.lit(0), "radio": F.lit(None).cast("double"), "lleno": F.lit(False)}))


def _discs(around: DataFrame, pool: int) -> DataFrame:
    """The stops of each driver's widest disc with at most ``pool`` stops, and its radius; null if nothing is outside.

    A first ring that is too full gives its nearest EN_ANILLO stops instead.
    """
    anillo = F.floor(F.log2(F.col("d") * 1000 + 1) * ANILLOS_POR_OCTAVA).cast("int")
    con_anillo = around.withColumn("anillo", anillo)
    cuenta = con_anillo.groupBy(*CONDUCTOR, "anillo").agg(F.count(F.lit(1)).alias("n"))
    hasta = Window.partitionBy(*CONDUCTOR).orderBy("anillo").rowsBetween(Window.unboundedPreceding, 0)
    cuenta = cuenta.withColumns({"hasta": F.sum("n").over(hasta), "todas": F.sum("n").over(Window.partitionBy(*CONDUCTOR))})
    discos = cuenta.groupBy(*CONDUCTOR).agg(
        F.max(F.when(F.col("hasta") <= pool, F.col("anillo"))).alias("ultimo"), F.min("anillo").alias("primero"),
        F.max(F.when(F.col("hasta") <= pool, F.col("hasta") == F.col("todas"))).alias("completo"))
    junto = con_anillo.join(discos, CONDUCTOR)
    borde = (F.pow(F.lit(2.0), (F.col("ultimo") + 1) / ANILLOS_POR_OCTAVA) - 1) / 1000
    dentro = junto.filter(F.col("anillo") <= F.col("ultimo")).withColumns({"radio": F.when(~F.col("completo"), borde), "lleno": F.lit(False)})
    cerca = Window.partitionBy(*CONDUCTOR).orderBy("d", F.asc_nulls_last("id_usuario"), "fila")
    llenos = junto.filter(F.col("ultimo").isNull() & (F.col("anillo") == F.col("primero")))
    llenos = llenos.withColumn("puesto", F.row_number().over(cerca)).filter(F.col("puesto") <= min(pool, EN_ANILLO)).drop("puesto")
    llenos = llenos.join(llenos.groupBy(*CONDUCTOR).agg(F.max("d").alias("radio")), CONDUCTOR).withColumn("lleno", F.lit(True))
    return dentro.unionByName(llenos.select(*dentro.columns)).drop("anillo", "ultimo", "primero", "completo")


def _drop(spark: SparkSession, path: str) -> None:
    ruta = spark._jvm.org.apache.hadoop.fs.Path(path)
    ruta.getFileSystem(spark._jsc.hadoopConfiguration()).delete(ruta, True)


def _long(stops: DataFrame, pool: int) -> DataFrame:
    """Drivers with more stops than a pool: rounds over what is still open, each a table in the shared folder."""
    spark = stops.sparkSession
    carpeta = f"{shared_dir(spark)}/rutas-{uuid.uuid4().hex}"

    def written(df: DataFrame, nombre: str) -> DataFrame:
        df.write.parquet(f"{carpeta}/{nombre}")
        return spark.read.schema(df.schema).parquet(f"{carpeta}/{nombre}")

    con_fila = written(stops.withColumn("fila", F.monotonically_increasing_id()), "paradas")
    situadas = con_fila.filter(F.col("latitud").isNotNull() & F.col("longitud").isNotNull())
    posicion = situadas.groupBy(*CONDUCTOR).agg(F.first("latitud_actual").alias("lat"), F.first("longitud_actual").alias("lng"), F.lit(0.0).alias("total"), F.lit(0).alias("orden"))
    posicion = written(posicion, "posicion-0")
    abiertas, ronda = situadas.drop("latitud_actual", "longitud_actual"), 0
    faltan = abiertas.count()
    while faltan:
        alrededor = abiertas.join(posicion, CONDUCTOR).withColumn("d", _km("lat", "lng", "latitud", "longitud"))
        ultima = written(_walked(_discs(alrededor, pool)), f"visitas/ronda={ronda}")
        siguiente = written(abiertas.join(ultima.select("fila"), "fila", "left_anti").select(*abiertas.columns), f"abiertas-{ronda + 1}")
        quedan = siguiente.count()
        if quedan >= faltan:
            raise RuntimeError(f"{faltan} stops cannot be visited")
        if ronda:
            _drop(spark, f"{carpeta}/abiertas-{ronda}")
        paso = F.struct(F.col("latitud").alias("lat"), F.col("longitud").alias("lng"), "total", "orden")
        movida = ultima.groupBy(*CONDUCTOR).agg(F.max_by(paso, "orden").alias("p")).select(*CONDUCTOR, "p.*")
        posicion = written(movida, f"posicion-{ronda + 1}")
        abiertas, faltan, ronda = siguiente, quedan, ronda + 1
    visitas = spark.read.schema(VISITA + ", ronda int").parquet(f"{carpeta}/visitas").drop("ronda") if ronda else spark.createDataFrame([], VISITA)
    # Stops without a position follow, by id.
    dadas = visitas.groupBy(*CONDUCTOR).agg(F.count(F.lit(1)).cast("int").alias("dadas"))
    por_id = F.row_number().over(Window.partitionBy(*CONDUCTOR).orderBy(F.asc_nulls_last("id_usuario"), "fila"))
    perdidas = con_fila.filter(F.col("latitud").isNull() | F.col("longitud").isNull()).withColumn("puesto", por_id).join(dadas, CONDUCTOR, "left")
    nada = F.lit(None).cast("double")
    perdidas = perdidas.withColumns({"orden": F.col("puesto") + F.coalesce("dadas", F.lit(0)), "tramo": nada, "total": nada})
    todas = con_fila.groupBy(*CONDUCTOR).agg(F.count(F.lit(1)).alias("total_paradas"))
    finales = visitas.groupBy(*CONDUCTOR).agg(F.max("total").alias("final"))
    visitas = visitas.drop("total_paradas", "final")
    return visitas.unionByName(perdidas.select(*visitas.columns)).join(todas.join(finales, CONDUCTOR, "left"), CONDUCTOR)


def routes(stops: DataFrame, pool: int = POOL) -> DataFrame:
    """Greedy open route of every driver through the users to visit, starting at the driver.

    ``stops``: source_db, id_repartidor, id_usuario, nombre, latitud, longitud, latitud_actual,
    longitud_actual. Of stops at one distance the smaller id comes first (null last); stops without a position come at the end, without
    distances. Drivers without an id or a position have no route, see ``unroutable``. Rounds over long routes are jobs that run
    when the plan is made; without a driver of more than ``pool`` stops there are none.
    """
    ship(stops.sparkSession)
    fuera = F.greatest(*[F.col(c).isNull() for c in (*CONDUCTOR, "latitud_actual", "longitud_actual")])
    limpias = stops.filter(~fuera).select(
        "source_db", F.col("id_repartidor").cast("bigint"), F.col("id_usuario").cast("bigint"), "nombre",
        *[F.col(c).cast("double") for c in ("latitud", "longitud", "latitud_actual", "longitud_actual")])
    largos = limpias.groupBy(*CONDUCTOR).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > pool).select(*CONDUCTOR)
    if largos.limit(1).count():
        cortas = limpias.join(largos, CONDUCTOR, "left_anti").withColumn("fila", F.lit(0).cast("long"))
        pasos = _short(cortas).unionByName(_long(limpias.join(largos, CONDUCTOR, "left_semi"), pool))
    else:
        pasos = _short(limpias.withColumn("fila", F.lit(0).cast("long")))
    return pasos.select(*CONDUCTOR, "orden", "id_usuario", "nombre", F.round("tramo", 2).alias("distancia_tramo"),
                        F.round("total", 2).alias("distancia_acumulada"), "total_paradas", F.round("final", 2).alias("distancia_total"))


def unroutable(stops: DataFrame) -> DataFrame:
    """Drivers with stops but without a position or an id, their number of stops and the reason."""
    sin_id = F.col("source_db").isNull() | F.col("id_repartidor").isNull()
    sin_lugar = F.col("latitud_actual").isNull() | F.col("longitud_actual").isNull()
    return (
        stops.filter(sin_id | sin_lugar)
        .groupBy("source_db", "id_repartidor").agg(F.count(F.lit(1)).alias("total_paradas"))
        .withColumn("motivo", F.when(sin_id, "Repartidor sin identificador").otherwise("Repartidor sin ubicación"))
    )
