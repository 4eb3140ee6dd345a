"""The star-schema warehouse: Parquet tables under one base folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon import schemas
from fogon.sources.keys import COMPRESION, KeyTable

# Seeded locations (id, name, lat min, lat max, lng min, lng max, active, description).
UBICACIONES = [
    (1, "San José", "9.8", "10.1", "-84.4", "-84.0", True, "Provincia central, área metropolitana"),
    (2, "Cartago", "9.7", "10.2", "-84.2", "-83.6", True, "Provincia este, zona montañosa"),
    (3, "Heredia", "9.9", "10.5", "-84.4", "-84.0", True, "Provincia norte del Valle Central"),
    (4, "Alajuela", "10.0", "10.9", "-84.9", "-84.1", True, "Provincia oeste, incluye aeropuerto"),
    (5, "Guanacaste", "10.2", "11.2", "-86.0", "-85.0", True, "Provincia noroeste, zona seca"),
    (6, "Puntarenas", "8.5", "11.0", "-85.9", "-84.6", True, "Provincia oeste, costa Pacífico"),
    (7, "Limón", "8.5", "11.2", "-84.0", "-82.5", True, "Provincia este, costa Caribe"),
    (8, "Sin Ubicación", None, None, None, None, False, "Coordenadas no válidas o no disponibles"),
]


def seed_ubicacion(spark: SparkSession) -> DataFrame:
    filas = spark.createDataFrame(
        UBICACIONES,
        "ubicacion_id INT, provincia STRING, latitud_min STRING, latitud_max STRING, "
        "longitud_min STRING, longitud_max STRING, es_zona_activa BOOLEAN, descripcion STRING",
    )
    return conform(filas, "dim_ubicacion")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``table`` in order, cast to their declared types."""
    return df.select(*[F.col(c).cast(tipo).alias(c) for c, tipo in schemas.TABLAS[table].items()])


def month_folder(anio: int | None, mes: int | None) -> str:
    return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(schemas.PARTICIONES, (anio, mes)))


class Warehouse:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def table(self, name: str) -> DataFrame:
        """A warehouse table; partition columns are typed by the declared schema."""
        return self.spark.read.schema(schemas.ddl(schemas.TABLAS[name])).parquet(self.path(name))

    def init(self) -> "Warehouse":
        """Create every table empty where it is missing, and seed the locations."""
        for name, columnas in schemas.TABLAS.items():
            vacia = self.spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in columnas.items()])
            if name == "dim_ubicacion":
                vacia = seed_ubicacion(self.spark)
            escritor = vacia.write.mode("ignore")
            if name in schemas.HECHOS:
                escritor = escritor.partitionBy(*schemas.PARTICIONES)
            escritor.parquet(self.path(name))
        return self

    def append(
        self, df: DataFrame, table: str, rows: int | None = None, keys: DataFrame | None = None, by_month: bool = False
    ) -> None:
        """Append rows, conformed to the declared columns and types; ``rows`` is their number and ``keys`` a cheaper source of
        their keys, where there are such.

        Facts are rebalanced by partition first, so that every (anio, mes) folder gets few, evenly sized
        files; adaptive execution splits a month that is too large for one task. ``by_month``: the tasks of ``df`` hold few months
        each already, as the files of a fact do, so the rows are not shuffled again. Their keys are added to the key table.
        """
        filas = conform(df, table)
        if table in schemas.HECHOS:
            self.recover(table)
            with self.keys(table).added(filas if keys is None else keys, rows):
                por_mes = filas if by_month else filas.hint("rebalance", *schemas.PARTICIONES)
                por_mes.write.mode("append").partitionBy(*schemas.PARTICIONES).parquet(self.path(table), compression=COMPRESION)
        else:
            filas.hint("rebalance").write.mode("append").parquet(self.path(table), compression=COMPRESION)

    def keys(self, table: str) -> "KeyTable":
        return KeyTable(self, table)

    def _fs(self, path: str):
        ruta = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return ruta.getFileSystem(self.spark._jsc.hadoopConfiguration()), ruta

    def _exists(self, path: str) -> bool:
        fs, ruta = self._fs(path)
        return fs.exists(ruta)

    def months(self, table: str, meses: list[tuple[int | None, int | None]]) -> DataFrame:
        """Rows of a fact in the given (anio, mes); only these folders are listed."""
        carpetas = [f"{self.path(table)}/{month_folder(*m)}" for m in meses]
        carpetas = [x for x in carpetas if self._exists(x)]
        esquema = schemas.ddl(schemas.TABLAS[table])
        if not carpetas:
            return self.spark.createDataFrame([], esquema)
        return self.spark.read.schema(esquema).option("basePath", self.path(table)).parquet(*carpetas)

    def replace_months(self, table: str, meses: list[tuple[int | None, int | None]], rows: DataFrame, run: str) -> None:
        """``rows`` instead of what the given months of a fact hold; other months that ``rows`` reach must be among them.

        The new files are written beside the fact first, then take the places of the old ones month by month. A run that dies
        before the first step is complete has changed nothing; one that dies later is finished by ``recover``.
        One writer of a fact at a time.
        """
        diario = f"{self.path('_cambios')}/{table}/{run}"
        filas = conform(rows, table).hint("rebalance", *schemas.PARTICIONES)
        filas.write.partitionBy(*schemas.PARTICIONES).parquet(f"{diario}/filas", compression=COMPRESION)
        fs, _ = self._fs(diario)
        for m in meses:
            fs.mkdirs(self._fs(f"{diario}/meses/{month_folder(*m)}")[1])
        fs.create(self._fs(f"{diario}/_completo")[1]).close()
        self.recover(table)

    def recover(self, table: str) -> None:
        """Finish replacements of months that were written and not put in place; drop those that were not written to the end."""
        fs, cambios = self._fs(f"{self.path('_cambios')}/{table}")
        if not fs.exists(cambios):
            return
        for diario in [s.getPath() for s in fs.listStatus(cambios)]:
            if self._exists(f"{diario}/_completo"):
                for mes in self._month_folders(f"{diario}/meses"):
                    nuevo, viejo = self._fs(f"{diario}/filas/{mes}")[1], self._fs(f"{self.path(table)}/{mes}")[1]
                    fs.delete(viejo, True)
                    if fs.exists(nuevo):
                        fs.mkdirs(viejo.getParent())
                        if not fs.rename(nuevo, viejo):
                            raise RuntimeError(f"{nuevo} could not take the place of {viejo}")
                    fs.delete(self._fs(f"{diario}/meses/{mes}")[1], True)
            fs.delete(diario, True)

    def _month_folders(self, path: str) -> list[str]:
        fs, ruta = self._fs(path)
        anios = [s.getPath() for s in fs.listStatus(ruta)] if fs.exists(ruta) else []
        return [f"{a.getName()}/{m.getPath().getName()}" for a in anios for m in fs.listStatus(a)]

    def stage(self, df: DataFrame, name: str, run: str = "manual") -> DataFrame:
        """``df`` written below the warehouse, in a folder of the run: runs side by side do not meet."""
        ruta = self.path(f"_staging/{run}/{name}")
        df.write.mode("overwrite").parquet(ruta, compression=COMPRESION)
        return self.spark.read.schema(df.schema).parquet(ruta)

    def drop_staging(self, run: str) -> None:
        ruta = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(f"_staging/{run}"))
        ruta.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(ruta, True)

    def reject(self, df: DataFrame, table: str) -> None:
        """Append rows that cannot be loaded, with their ``motivo``, to the reject table of a fact."""
        df.write.mode("append").parquet(self.path(f"_rechazos/{table}"))

    def rejects(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(f"_rechazos/{table}"))

    def register(self, database: str = "warehouse", cubes: dict[str, DataFrame] | None = None) -> None:
        """Catalog tables over the folders, and over the given cubes, which are written (see ``publish``)."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.path('_database')}'")
        for name, columnas in schemas.TABLAS.items():
            particiones = f"PARTITIONED BY ({', '.join(schemas.PARTICIONES)})" if name in schemas.HECHOS else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {database}.{name} ({schemas.ddl(columnas)}) USING parquet "
                f"{particiones} LOCATION '{self.path(name)}'"
            )
            if particiones:
                self.spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")
        for name, df in (cubes or {}).items():
            self.publish(database, name, df)

    def publish(self, database: str, name: str, df: DataFrame) -> None:
        """``df`` as a catalog table that every session of the catalog reads by name, written to a folder of its own.

        Publishing a name again writes a new version and points the table to it, so readers see the old rows or the new ones. The
        version before stays for queries that are under way; those before it are deleted.
        """
        base = self.path(f"_cubos/{name}")
        fs, raiz = self._fs(base)
        versiones = sorted(int(s.getPath().getName()) for s in fs.listStatus(raiz)) if fs.exists(raiz) else []
        ruta = f"{base}/{versiones[-1] + 1 if versiones else 1:08d}"
        df.write.parquet(ruta)
        tabla = f"{database}.{name}"
        columnas = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        if self.spark.catalog.tableExists(tabla) and self.spark.table(tabla).schema.simpleString() == df.schema.simpleString():
            self.spark.sql(f"ALTER TABLE {tabla} SET LOCATION '{ruta}'")
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {tabla}")
            self.spark.sql(f"CREATE TABLE {tabla} ({columnas}) USING parquet LOCATION '{ruta}'")
        self.spark.catalog.refreshTable(tabla)
        for v in versiones[:-1]:
            fs.delete(self._fs(f"{base}/{v:08d}")[1], True)


def out_of_range(df: DataFrame, table: str) -> Column:
    """Which values of a row the types of the table cannot hold; null if all fit."""
    malos = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(tipo).isNull(), F.lit(f"{c} fuera de rango"))
        for c, tipo in schemas.TABLAS[table].items() if c in df.columns
    ]
    return F.nullif(F.concat_ws(", ", *malos), F.lit(""))


def init_warehouse(spark: SparkSession, base: str) -> Warehouse:
    return Warehouse(spark, base).init()


def query(spark: SparkSession, sql: str) -> DataFrame:
    """SQL over the registered tables and views."""
    return spark.sql(sql)


def write_fact(warehouse: Warehouse, df: DataFrame, table: str) -> None:
    warehouse.append(df, table)
