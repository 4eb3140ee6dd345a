"""Keys of the fact tables in hash buckets, so that an increment is looked up without reading the history.

A load writes the keys of its rows, and the months that hold them, to folders ``n=<buckets>/cubeta=<bucket>``, with a number of buckets
(a power of two) that follows its size. A row that moves to another month gets a second entry; the first one stays. A key's bucket is the low bits of its hash, so the buckets of a batch are known from the batch, whatever ``n`` a folder was written
with, and only those folders are read. While rows are being appended a mark stands beside the keys; a run that finds one, left by a run
that died between facts and keys, builds the key table anew from the facts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fogon import schemas

if TYPE_CHECKING:
    from fogon.sources.warehouse import Warehouse

CLAVES_POR_CUBETA = 100_000
COMPRESION = "zstd"  # of the warehouse's files
MAX_CUBETAS = 1 << 16


def buckets_for(rows: int) -> int:
    """Power of two with about CLAVES_POR_CUBETA keys a bucket."""
    return min(MAX_CUBETAS, 1 << max(0, -(-rows // CLAVES_POR_CUBETA) - 1).bit_length())


class KeyTable:
    def __init__(self, almacen: "Warehouse", table: str):
        self.almacen, self.spark, self.table = almacen, almacen.spark, table
        self.claves = schemas.CLAVES[table]
        self.path = almacen.path(f"_claves_mes/{table}")

    def _fs(self, path: str):
        ruta = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return ruta.getFileSystem(self.spark._jsc.hadoopConfiguration()), ruta

    def _names(self, path: str) -> list[str]:
        fs, ruta = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(ruta)] if fs.exists(ruta) else []

    def _typed(self, df: DataFrame) -> DataFrame:
        """The key columns with their declared types: equal keys have equal hashes."""
        return df.select(*[F.col(c).try_cast(schemas.TABLAS[self.table][c]).alias(c) for c in self.claves])

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Keys with their months; rows that have no month columns yet have the event time."""
        if set(schemas.PARTICIONES) <= set(rows.columns):
            meses = {c: F.col(c).cast("int") for c in schemas.PARTICIONES}
        else:
            meses = {"anio": F.year("fecha_hora"), "mes": F.month("fecha_hora")}
        claves = [F.col(c).try_cast(schemas.TABLAS[self.table][c]).alias(c) for c in self.claves]
        return rows.select(*claves, *[m.alias(c) for c, m in meses.items()])

    def _bucket(self, n: int) -> Column:
        return F.xxhash64(*self.claves).bitwiseAND(F.lit(n - 1)).cast("int")

    @contextmanager
    def added(self, rows: DataFrame, count: int | None = None) -> Iterator[None]:
        """Around the write of ``rows`` to the facts; their keys follow it."""
        self.ensure()
        fs, marca = self._fs(f"{self.path}/_pendiente-{uuid.uuid4().hex}")
        fs.create(marca).close()
        yield
        self._write(rows, count)
        fs.delete(marca, False)

    def moved(self, rows: DataFrame, count: int) -> None:
        """Note other months of keys that the table holds."""
        self._write(rows, count)

    def _write(self, rows: DataFrame, count: int | None) -> None:
        n = buckets_for(rows.count() if count is None else count)
        con_cubeta = self._placed(rows).withColumn("cubeta", self._bucket(n))
        en_cubetas = con_cubeta.repartition(min(n, 4096), "cubeta").sortWithinPartitions("cubeta", *self.claves)
        en_cubetas.write.mode("append").partitionBy("cubeta").parquet(f"{self.path}/n={n}", compression=COMPRESION)

    def ensure(self) -> None:
        """Build the key table from the facts where it is missing, or where a load did not come to its end."""
        nombres = self._names(self.path)
        if nombres and not any(x.startswith("_pendiente") for x in nombres):
            return
        self.rebuild()

    def rebuild(self) -> None:
        """All keys of the facts with one number of buckets. Also merges the small files of many small loads."""
        fs, ruta = self._fs(self.path)
        fs.delete(ruta, True)
        fs.mkdirs(ruta)
        fs, marca = self._fs(f"{self.path}/_pendiente-{uuid.uuid4().hex}")
        fs.create(marca).close()
        # Listed only now: what another run has written before is in the facts, what it writes later it adds itself.
        hechos = self.almacen.table(self.table)
        filas = hechos.count()
        if filas:
            self._write(hechos, filas)
        fs.mkdirs(self._fs(f"{self.path}/_listo")[1])
        fs.delete(marca, False)

    def folders(self, batch: DataFrame | None = None) -> list[str]:
        """Folders that can hold keys of ``batch`` (all of them by default). At most MAX_CUBETAS bucket numbers reach the driver."""
        self.ensure()
        niveles = sorted(int(x.partition("=")[2]) for x in self._names(self.path) if x.startswith("n="))
        if not niveles:
            return []
        propias = None if batch is None else [r.b for r in self._typed(batch).select(self._bucket(niveles[-1]).alias("b")).distinct().collect()]
        carpetas = []
        for n in niveles:
            buscadas = None if propias is None else {f"cubeta={b & (n - 1)}" for b in propias}
            carpetas += [f"{self.path}/n={n}/{x}" for x in self._names(f"{self.path}/n={n}") if x.startswith("cubeta=") and (buscadas is None or x in buscadas)]
        return sorted(carpetas)

    def read(self, batch: DataFrame | None = None) -> DataFrame:
        """The keys that the facts hold and their months, those of ``batch`` and others of its buckets; all of them by default."""
        tipos = {c: schemas.TABLAS[self.table][c] for c in (*self.claves, *schemas.PARTICIONES)}
        carpetas = self.folders(batch)
        if not carpetas:
            return self.spark.createDataFrame([], schemas.ddl(tipos))
        return self.spark.read.schema(schemas.ddl(tipos)).parquet(*carpetas)
