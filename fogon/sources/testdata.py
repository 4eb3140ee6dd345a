"""The given test tables mapped onto the operational sources (see FIXTURES.md)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FUENTES = ["postgres", "mongo"]

# Product category by part type; any other type has a blank category.
CATEGORIAS = {
    "SMALL": "Bebida", "STANDARD": "Plato principal", "MEDIUM": "Postre", "LARGE": "Entrada", "ECONOMY": "Combo",
}


def _minutos(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"), F.lit(0))


def _dias(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"), F.lit(0), F.lit(0), F.lit(0))


def fuente(clave: str) -> Column:
    return F.when(F.col(clave) % 3 == 0, "mongo").otherwise("postgres")


class SourceTables:
    """Operational tables as lazy DataFrames over the Parquet files of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def usuario(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.raw("customer").select(
            k.alias("id_usuario"),
            F.col("c_name").alias("nombre"),
            F.concat(F.lit("cliente"), F.when(k % 100 == 99, k - 1).otherwise(k).cast("string"),
                     F.lit("@correo.cr")).alias("email"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "administrador").otherwise("cliente").alias("rol"),
            (F.lit("2020-01-01").cast("timestamp_ntz") + _dias(k * 7 % 1000)).alias("fecha_registro"),
            F.when(k % 50 != 0, F.lit(8.5) + (k * 37 % 280) / 100.0).alias("latitud"),
            (F.lit(-86.0) + (k * 53 % 350) / 100.0).alias("longitud"),
            F.col("c_mktsegment").alias("direccion_completa"),
            F.when((k >= 10) & (k % 10 < 7), (k * 31 + 7) % (F.floor(k / 3) + 1)).alias("id_referido"),
        )

    @cached_property
    def restaurante(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.raw("supplier").select(
            k.alias("id_restaurante"),
            F.col("s_name").alias("nombre"),
            F.concat(F.lit("Calle "), F.col("s_nationkey").cast("string")).alias("direccion"),
            (k * 15).alias("id_admin"),
            (F.lit(9.0) + (k * 41 % 200) / 100.0).alias("latitud"),
            (F.lit(-85.5) + (k * 67 % 250) / 100.0).alias("longitud"),
        )

    @cached_property
    def repartidor(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.raw("supplier").select(
            k.alias("id_repartidor"),
            F.col("s_name").alias("nombre"),
            F.concat(F.lit("8"), F.lpad(k.cast("string"), 7, "0")).alias("telefono"),
            F.when(k % 2 == 0, "moto").otherwise("bicicleta").alias("vehiculo"),
            (F.lit(9.7) + (k * 17 % 40) / 100.0).alias("latitud_actual"),
            (F.lit(-84.4) + (k * 29 % 80) / 100.0).alias("longitud_actual"),
            F.when(k % 3 == 0, "ocupado").otherwise("disponible").alias("estado"),
        )

    @cached_property
    def menu(self) -> DataFrame:
        return (
            self.raw("part").select((F.col("p_partkey") % 40).alias("id_menu")).distinct()
            .select("id_menu", (F.col("id_menu") % 10).alias("id_restaurante"),
                    F.concat(F.lit("Menú "), F.col("id_menu").cast("string")).alias("nombre"))
        )

    @cached_property
    def producto(self) -> DataFrame:
        categoria = F.lit("")
        for tipo, nombre in CATEGORIAS.items():
            categoria = F.when(F.col("p_type") == tipo, nombre).otherwise(categoria)
        return self.raw("part").select(
            F.col("p_partkey").alias("id_producto"),
            (F.col("p_partkey") % 40).alias("id_menu"),
            F.col("p_name").alias("nombre"),
            categoria.alias("categoria"),
            F.col("p_retailprice").alias("precio"),
            F.col("p_brand").alias("descripcion"),
        )

    @cached_property
    def detalle(self) -> DataFrame:
        """Lines of both sources, with ``fuente_datos``."""
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("id_pedido"),
            F.col("l_linenumber").alias("id_detalle"),
            F.col("l_partkey").alias("id_producto"),
            F.col("l_quantity").cast("int").alias("cantidad"),
            F.col("l_extendedprice").alias("subtotal"),
            fuente("l_orderkey").alias("fuente_datos"),
        )

    @cached_property
    def pedido(self) -> DataFrame:
        """Orders of both sources, with ``fuente_datos``."""
        k = F.col("o_orderkey")
        restaurante = self.raw("lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("id_restaurante"))
        estado = (
            F.when(F.col("o_orderstatus") == "F", "entregado")
            .when(F.col("o_orderstatus") == "P", "pendiente")
            .when(k % 2 == 0, "en preparacion")
            .otherwise("listo")
        )
        return (
            self.raw("orders").join(restaurante, k == F.col("l_orderkey"), "left")
            .select(
                k.alias("id_pedido"),
                F.col("o_custkey").alias("id_usuario"),
                "id_restaurante",
                F.when(k % 4 != 0, F.floor(F.col("o_custkey") / 15)).alias("id_repartidor"),
                (F.col("o_orderdate") + _minutos(k * 17 % 1440)).alias("fecha_hora"),
                estado.alias("estado"),
                F.when(F.substring("o_orderpriority", 1, 1).isin("1", "2"), "en restaurante")
                .otherwise("para recoger").alias("tipo"),
                fuente("o_orderkey").alias("fuente_datos"),
            )
        )

    @cached_property
    def reserva(self) -> DataFrame:
        """Reservations of both sources, with ``fuente_datos``."""
        estado = (
            F.when(F.col("event_type") == "click", "pendiente")
            .when(F.col("event_type") == "error", "cancelada")
            .otherwise("confirmada")
        )
        return self.raw("events").select(
            F.col("event_id").alias("id_reserva"),
            F.col("user_id").alias("id_usuario"),
            (F.col("event_id") % 10).alias("id_restaurante"),
            F.col("ts").alias("fecha_hora"),
            estado.alias("estado"),
            fuente("event_id").alias("fuente_datos"),
        )

    def de_fuente(self, name: str, origen: str) -> DataFrame:
        return getattr(self, name).filter(F.col("fuente_datos") == origen).drop("fuente_datos")

    @cached_property
    def pedido_doc(self) -> DataFrame:
        """Orders of the document source, each with its array of lines."""
        from fogon.operators.maintenance import nest_orders

        return nest_orders(self.de_fuente("pedido", "mongo"), self.de_fuente("detalle", "mongo"))

    def en_fuentes(self, name: str) -> DataFrame:
        """A node table as both sources hold it: one copy per ``source_db``."""
        fuentes = F.explode(F.array(*map(F.lit, FUENTES))).alias("source_db")
        return getattr(self, name).select("*", fuentes)
