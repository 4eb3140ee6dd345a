"""Time, location, category and product dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fogon import schemas
from fogon.functions import calendar as cal
from fogon.functions import geo
from fogon.functions.ordered import join_nullsafe, row_numbers
from fogon.sources.keys import KeyTable

# Fixed value: category of products whose category is blank when they are loaded.
CATEGORIA_EN_BLANCO = "Especialidad"


def build_dim_tiempo(events: DataFrame) -> DataFrame:
    """One row per minute seen in ``fecha_hora``; its id is the epoch second of the first event in it."""
    primero = (
        events.filter(F.col("fecha_hora").isNotNull())
        .groupBy(cal.epoch_minutes(F.col("fecha_hora")).alias("_minuto"))
        .agg(F.min("fecha_hora").alias("ts"))
    )
    ts = F.col("ts")
    return primero.select(
        cal.epoch_seconds(ts).alias("tiempo_id"),
        cal.fecha(ts).alias("fecha"),
        F.hour(ts).alias("hora"),
        F.minute(ts).alias("minuto"),
        F.year(ts).alias("anio"),
        F.month(ts).alias("mes"),
        F.day(ts).alias("dia"),
        F.quarter(ts).alias("trimestre"),
        cal.dia_semana(ts).alias("dia_semana"),
        cal.es_fin_semana(ts).alias("es_fin_semana"),
        cal.es_horario_pico(F.hour(ts)).alias("es_horario_pico"),
    )


def missing_tiempo(events: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows to add to the time dimension: minutes of ``events`` it does not have yet."""
    return build_dim_tiempo(events).join(dim, schemas.CLAVES["dim_tiempo"], "left_anti")


def assign_tiempo(events: DataFrame, dim: DataFrame) -> DataFrame:
    """Add ``tiempo_id``. An id lies inside its minute, and the dimension has one id a minute.

    The ids of an hour are gathered into one array of 60 seconds, so what is broadcast grows with the hours of the calendar that
    hold events (8,766 rows a year at most), not with the events, and ``events`` are not shuffled.
    """
    id_, minuto = F.col("tiempo_id"), cal.epoch_minutes(F.col("fecha_hora"))
    dentro = F.struct(F.pmod(F.floor(id_ / 60), F.lit(60)).cast("int").alias("m"), F.pmod(id_, F.lit(60)).cast("byte").alias("s"))
    horas = dim.filter(id_.isNotNull()).groupBy(F.floor(id_ / 3600).alias("_hora")).agg(F.collect_list(dentro).alias("_ids")).select(
        "_hora",
        F.transform(F.sequence(F.lit(0), F.lit(59)), lambda m: F.array_min(F.filter("_ids", lambda x: x.m == m)).s).alias("_segundos"),
    )
    con_hora = events.withColumns({"_minuto": minuto, "_hora": F.floor(minuto / 60)}).join(F.broadcast(horas), "_hora", "left")
    segundo = F.get("_segundos", (F.col("_minuto") - F.col("_hora") * 60).cast("int"))
    return con_hora.withColumn("tiempo_id", F.col("_minuto") * 60 + segundo).drop("_hora", "_minuto", "_segundos")


def resolve_tiempo(events: DataFrame, dim: DataFrame) -> DataFrame:
    """Events with ``tiempo_id``, reusing ids of ``dim`` and creating those of unseen minutes."""
    return assign_tiempo(events, dim.unionByName(missing_tiempo(events, dim)))


def with_provincia(df: DataFrame, lat: str, lng: str, out: str) -> DataFrame:
    return df.withColumn(out, geo.provincia(F.col(lat), F.col(lng)))


def provincia_by_range(df: DataFrame, dim_ubicacion: DataFrame, lat: str, lng: str, out: str) -> DataFrame:
    """Province by the boxes of the location dimension; of overlapping boxes the lowest id wins.

    The dimension has one row per province, so its boxes are gathered into one array that is
    scanned per row: no range join, no shuffle of ``df`` and no row multiplied by overlapping boxes.
    """
    cajas = (
        dim_ubicacion.filter(F.col("latitud_min").isNotNull())
        .agg(F.sort_array(F.collect_list(F.struct(
            "ubicacion_id", "provincia",
            *[F.col(c).cast("double").alias(c) for c in ("latitud_min", "latitud_max", "longitud_min", "longitud_max")],
        ))).alias("cajas"))
        .scalar()
    )
    dentro = F.filter(
        "_cajas",
        lambda c: F.col(lat).between(c.latitud_min, c.latitud_max) & F.col(lng).between(c.longitud_min, c.longitud_max),
    )
    nombre = F.coalesce(F.try_element_at(dentro, F.lit(1)).provincia, F.lit(geo.SIN_UBICACION))
    return df.withColumn("_cajas", cajas).withColumn(out, nombre).drop("_cajas")


def categoria_efectiva(col):
    """Category under which a product is loaded: a missing or blank one becomes the default."""
    return F.when(F.trim(col) != "", col).otherwise(CATEGORIA_EN_BLANCO)


def missing_categorias(products: DataFrame, dim: DataFrame, columna: str = "categoria_producto") -> DataFrame:
    """Category rows to add. Known names keep their id; new ids follow the largest one, by name."""
    nuevas = (
        products.select(categoria_efectiva(F.col(columna)).alias("nombre_categoria"))
        .distinct()
        .join(dim, "nombre_categoria", "left_anti")
    )
    base = dim.agg(F.coalesce(F.max("categoria_id"), F.lit(0))).scalar()
    return row_numbers(nuevas, "nombre_categoria", "_n").select(
        (base + F.col("_n")).cast("int").alias("categoria_id"), "nombre_categoria"
    )


def upsert_categorias(products: DataFrame, dim: DataFrame, columna: str = "categoria_producto") -> DataFrame:
    """The category dimension including the categories of ``products``."""
    return dim.unionByName(missing_categorias(products, dim, columna))


def assign_categoria(lines: DataFrame, dim: DataFrame, columna: str = "categoria_producto") -> DataFrame:
    con_nombre = lines.withColumn("nombre_categoria", categoria_efectiva(F.col(columna)))
    return con_nombre.join(dim, "nombre_categoria", "left").drop("nombre_categoria")


def missing_productos(lines: DataFrame, dim: DataFrame) -> DataFrame:
    """Product rows to add, one per (product, source) not in ``dim``; ``lines`` carry ``categoria_id``.

    Lines of one product agree on its catalog columns; where they do not, the smallest tuple is kept so
    that a rerun gives the same row.
    """
    claves = schemas.CLAVES["dim_productos"]
    ficha = F.struct("nombre_producto", "categoria_id", "precio_producto", "id_menu", "id_restaurante")
    return (
        lines.withColumnRenamed("id_producto", "producto_id")
        .groupBy(*claves).agg(F.min(ficha).alias("f"))
        .join(dim.select(*claves), claves, "left_anti")
        .select(
            "producto_id",
            F.col("f.nombre_producto").alias("nombre"),
            "f.categoria_id",
            F.col("f.precio_producto").cast(schemas.DINERO).alias("precio_actual"),
            F.col("f.precio_producto").cast(schemas.DINERO).alias("precio_promedio"),
            "f.id_menu",
            "f.id_restaurante",
            F.lit(True).alias("activo"),
            F.current_timestamp().cast("string").alias("fecha_ultima_actualizacion"),
            "fuente_datos",
        )
    )


def upsert_productos(lines: DataFrame, dim: DataFrame) -> DataFrame:
    """The product dimension including the products of ``lines``."""
    return dim.unionByName(missing_productos(lines, dim).select(*dim.columns))


def only_new(df: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in ``target``; repeats inside ``df`` stay. NULL keys compare equal.

    The target is reduced to the keys of ``df`` first. Where those are few (an increment, staged), Spark broadcasts them:
    the key columns of the target are scanned, but nothing of it is shuffled.
    """
    cargadas = join_nullsafe(target.select(*keys), df.select(*keys), keys, "left_semi")
    return join_nullsafe(df, cargadas, keys, "left_anti")


def only_new_keys(df: DataFrame, loaded: KeyTable, staged: bool) -> DataFrame:
    """Rows whose key a fact table does not hold, by its key table: a staged batch reads the buckets of its own keys only.

    Rows that are not staged are compared with all keys at once: to reduce the keys to theirs first would extract them twice.
    """
    carpetas = loaded.folders(df if staged else None)
    if not carpetas:
        return df
    if staged:
        return only_new(df, loaded.read(df), loaded.claves)
    return join_nullsafe(df, loaded.read().select(*loaded.claves), loaded.claves, "left_anti")
