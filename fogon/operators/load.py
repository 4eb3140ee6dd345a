"""Loads into the fact tables and the whole ETL run.

Extract and key check of one fact are one lazy plan, staged once; enrichment reads the staged rows. No row
passes through the driver. Dimensions are written before the facts that point to them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fogon import schemas
from fogon.functions import calendar as cal
from fogon.functions import geo
from fogon.functions.ordered import join_nullsafe
from fogon.functions.sizing import broadcast_if_few
from fogon.operators import dimensions as dims
from fogon.operators import extract
from fogon.sources.warehouse import Warehouse, out_of_range


# Rows alike lie side by side in the staged files: these, and the shuffle of their rows by month, compress better.
PARECIDAS = {
    "fact_pedidos": ["estado", "tipo", "fuente_datos", "fecha_hora"],
    "fact_reservas": ["estado", "fuente_datos", "fecha_hora"],
    "fact_detalle_pedidos": ["estado_pedido", "tipo_pedido", "fuente_datos", *extract.ZONAS, "fecha_hora"],
}


def _stamp(df: DataFrame) -> DataFrame:
    """Creation and load time texts, and the partition columns taken from the event time."""
    ts = F.col("fecha_hora")
    return df.withColumns({
        "fecha_creacion": cal.iso_text(ts),
        "fecha_etl": F.current_timestamp().cast("string"),
        "anio": F.year(ts),
        "mes": F.month(ts),
    })


def _zonas(df: DataFrame) -> DataFrame:
    """Numbers of the provinces, where the rows do not have them yet."""
    return df if set(extract.ZONAS) <= set(df.columns) else extract.with_zones(df, list(extract.ZONAS.values()))


def _provincias(df: DataFrame) -> DataFrame:
    return _zonas(df).withColumns({z.replace("zona", "provincia"): geo.nombre_zona(F.col(z)) for z in extract.ZONAS})


def load_fact_pedidos(df: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    return _stamp(_provincias(dims.assign_tiempo(df, dim_tiempo)))


def load_fact_reservas(df: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    return _stamp(dims.assign_tiempo(df, dim_tiempo))


def load_fact_detalle(df: DataFrame, dim_tiempo: DataFrame, dim_categorias: DataFrame) -> DataFrame:
    return _stamp(dims.assign_tiempo(_provincias(dims.assign_categoria(df, dim_categorias)), dim_tiempo))


def _by_month(df: DataFrame, tabla: str) -> DataFrame:
    """Rows gathered by month before what follows from them is added: only the columns of the fact that they have, in its types, and the event time."""
    columnas = {c: tipo for c, tipo in schemas.TABLAS[tabla].items() if c in df.columns and c not in schemas.PARTICIONES}
    return df.select(
        *[F.col(c).cast(tipo).alias(c) for c, tipo in columnas.items()],
        *[z for z in extract.ZONAS if z in df.columns], "fecha_hora", F.year("fecha_hora").alias("anio"), F.month("fecha_hora").alias("mes"),
    ).hint("rebalance", *schemas.PARTICIONES)


@dataclass
class Extracted:
    """Extracted rows of one run, both sources together. Order lines have zones or coordinates."""

    pedidos: DataFrame
    reservas: DataFrame
    detalle: DataFrame


def extract_all(rel: dict[str, DataFrame], doc: dict[str, DataFrame]) -> Extracted:
    """``rel`` and ``doc`` map table names to DataFrames of the relational and the document source.

    Users are joined four times; many of them are shuffled, not broadcast by the size of their files.
    """
    rel, doc = ({**tablas, "usuario": broadcast_if_few(tablas["usuario"])} for tablas in (rel, doc))
    pedidos = extract.union_sources(
        postgres=extract.extract_pedidos_rel(rel["pedido"], rel["detalle"], rel["usuario"], rel["restaurante"]),
        mongo=extract.extract_pedidos_doc(doc["pedido"], doc["usuario"], doc["restaurante"]),
    )
    reservas = extract.union_sources(
        postgres=extract.extract_reservas_rel(rel["reserva"]), mongo=extract.extract_reservas_doc(doc["reserva"])
    )
    detalle = extract.union_sources(
        postgres=extract.extract_detalle_rel(
            rel["detalle"], rel["pedido"], rel["producto"], rel["menu"], rel["restaurante"], rel["usuario"], zonas=True
        ),
        mongo=extract.extract_detalle_doc(doc["pedido"], doc["producto"], doc["usuario"], doc["restaurante"], zonas=True),
    )
    return Extracted(pedidos, reservas, detalle)


def _missing(df: DataFrame, almacen: Warehouse, tabla: str, corrida: str) -> DataFrame:
    """Rows whose key a fact table does not hold.

    The keys are extracted and compared by themselves first, and whole rows only if some of them are new. So a run over the same input
    shuffles keys alone, and one over much old and some new data does not shuffle whole rows that it then drops.
    """
    claves = almacen.keys(tabla)
    if not claves.folders():
        return df
    nuevas = almacen.stage(dims.only_new_keys(df.select(*claves.claves), claves, staged=False).distinct(), f"claves_{tabla}", corrida)
    return df.limit(0) if nuevas.isEmpty() else join_nullsafe(df, broadcast_if_few(nuevas), claves.claves, "left_semi")


def run_etl(extracted: Extracted, almacen: Warehouse, incremental: bool = False) -> dict[str, int]:
    """Load what the warehouse does not have yet; returns rows loaded per table.

    Facts are looked up by their natural key first, in the key table, so a second run over the same input loads nothing. The
    new rows are staged once; dimensions and facts are then derived from the staged columns, not from the
    sources again. ``incremental`` stages the extracted rows as well, before the lookup: the batch and so the buckets of its
    keys are then known, and only these are read. Rows with a value that its column cannot hold go to
    the reject table with the reason; the others are loaded. Each run stages in a folder of its own.
    """
    almacen.init()
    corrida = uuid.uuid4().hex
    nuevos, cargadas = {}, {}
    for tabla, df in (
        ("fact_pedidos", extracted.pedidos),
        ("fact_reservas", extracted.reservas),
        ("fact_detalle_pedidos", extracted.detalle),
    ):
        if incremental:
            faltan = dims.only_new_keys(almacen.stage(df, f"lote_{tabla}", corrida), almacen.keys(tabla), staged=True)
        else:
            faltan = _missing(df, almacen, tabla, corrida)
        filas = almacen.stage(faltan.sortWithinPartitions(*[x for x in PARECIDAS[tabla] if x in faltan.columns]), tabla, corrida)
        motivo = out_of_range(filas, tabla)
        todas, malas = filas.agg(F.count(F.lit(1)), F.count(motivo)).first()
        if malas:
            almacen.reject(filas.withColumn("motivo", motivo).filter("motivo is not null"), tabla)
        nuevos[tabla], cargadas[tabla] = filas.filter(motivo.isNull()) if malas else filas, todas - malas
    lineas = nuevos["fact_detalle_pedidos"]
    eventos = None
    for df in nuevos.values():
        horas = df.select("fecha_hora")
        eventos = horas if eventos is None else eventos.unionByName(horas)

    def add_dimension(tabla: str, faltan: DataFrame) -> DataFrame:
        faltan = almacen.stage(faltan, tabla, corrida)
        cargadas[tabla] = faltan.count()
        if cargadas[tabla]:
            almacen.append(faltan, tabla)
        return almacen.table(tabla)

    tiempo = add_dimension("dim_tiempo", dims.missing_tiempo(eventos, almacen.table("dim_tiempo")))
    categorias = add_dimension(
        "dim_categorias", dims.missing_categorias(lineas, almacen.table("dim_categorias"))
    )
    add_dimension(
        "dim_productos",
        dims.missing_productos(dims.assign_categoria(lineas, categorias), almacen.table("dim_productos")),
    )
    propias = {
        "fact_pedidos": _zonas,
        "fact_reservas": lambda df: df,
        "fact_detalle_pedidos": lambda df: _zonas(dims.assign_categoria(df, categorias)),
    }
    for tabla, propia in propias.items():
        if cargadas[tabla]:
            filas = _stamp(dims.assign_tiempo(_by_month(propia(nuevos[tabla]), tabla), tiempo))
            filas = _provincias(filas) if tabla != "fact_reservas" else filas
            almacen.append(filas, tabla, cargadas[tabla], nuevos[tabla], by_month=True)
    almacen.drop_staging(corrida)
    return cargadas
