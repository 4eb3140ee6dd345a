"""Pages of a sorted listing, read without sorting it again.

``Listing.write`` sorts the rows once, in ranges, and keeps how many each range holds. A page adds up these counts, which are few, and
reads the ranges it lies in: a page deep in the listing costs as much as the first one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from fogon.functions.sizing import plan_bytes

# Compressed data of a range.
BYTES_POR_RANGO = 16 * 1024 * 1024


class Listing:
    """Rows of ``path`` in the given order within each value of ``group`` (or in all); the listing has no column ``rango``."""

    def __init__(self, spark: SparkSession, path: str, order: list[Column | str], group: str | None = None):
        self.spark, self.path, self.order, self.group = spark, path.rstrip("/"), order, group

    def write(self, df: DataFrame, ranges: int | None = None) -> "Listing":
        """Sort ``df`` into ranges. ``order`` should end in a unique column: rows equal in all of it have no fixed place.

        The rows are written as they come first: bounds of ranges are sampled, which would run the plan twice, and the size is known then.
        """
        fs_ruta = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/sin_orden")
        df.write.mode("overwrite").parquet(f"{self.path}/sin_orden")
        df.limit(0).write.mode("overwrite").parquet(f"{self.path}/esquema")
        filas = self.spark.read.schema(df.schema).parquet(f"{self.path}/sin_orden")
        n = ranges or max(1, -(-plan_bytes(filas) // BYTES_POR_RANGO))
        claves = ([self.group] if self.group else []) + self.order
        # One range is one task; adaptive execution leaves a stated number of ranges as it is.
        en_rangos = filas.repartitionByRange(n, *claves).withColumn("rango", F.spark_partition_id())
        en_rangos.sortWithinPartitions("rango", *claves).write.mode("overwrite").partitionBy("rango").parquet(f"{self.path}/filas")
        grupo = F.col(self.group).cast("string") if self.group else F.lit(None).cast("string")
        cuentas = self._rows().groupBy("rango", grupo.alias("grupo")).agg(F.count(F.lit(1)).alias("n"))
        cuentas.write.mode("overwrite").parquet(f"{self.path}/cuentas")
        fs_ruta.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(fs_ruta, True)
        return self

    def _rows(self) -> DataFrame:
        esquema = self.spark.read.parquet(f"{self.path}/esquema").schema.add("rango", "integer")
        return self.spark.read.schema(esquema).parquet(f"{self.path}/filas")

    def _places(self, value: object) -> DataFrame:
        """(rango, n, desde, total): the ranges that hold the group, each with the rows before it and those of all."""
        cuentas = self.spark.read.parquet(f"{self.path}/cuentas")
        if self.group:
            cuentas = cuentas.filter(F.col("grupo").eqNullSafe(F.lit(value).cast("string")))
        todas = Window.partitionBy("grupo")
        antes = todas.orderBy("rango").rowsBetween(Window.unboundedPreceding, -1)
        return cuentas.select("rango", "n", F.coalesce(F.sum("n").over(antes), F.lit(0)).alias("desde"), F.sum("n").over(todas).alias("total"))

    def tocados(self, page: int, size: int, value: object = None) -> list[Row]:
        """(rango, n, desde, total) of the ranges that a page touches, found by Spark: the driver gets no others."""
        desde = (page - 1) * size
        return self._places(value).filter((F.col("desde") < desde + size) & (F.col("desde") + F.col("n") > desde)).orderBy("rango").collect()

    def page(self, page: int = 1, size: int = 10, value: object = None) -> DataFrame:
        """One page, with the ``total`` number of rows (of the group ``value``). Pages past the end are empty."""
        desde = (page - 1) * size
        tocados = self.tocados(page, size, value)
        filas = self._rows().filter(F.col("rango").isin([r.rango for r in tocados]) if tocados else F.lit(False))
        if self.group:
            filas = filas.filter(F.col(self.group).eqNullSafe(F.lit(value)))
        salto, total = (desde - tocados[0].desde, tocados[0].total) if tocados else (0, 0)
        return filas.drop("rango").orderBy(*self.order).offset(salto).limit(size).withColumn("total", F.lit(total).cast("long"))
