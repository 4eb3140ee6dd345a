"""Everything a registered query needs: source tables, the loaded warehouse, the graph tables.

The warehouse, the search index and the larger edge tables are written once per application and input folder, below the shared
folder named by ``spark.checkpoint.dir``; every query then reads those Parquet tables.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon.functions.sizing import plan_bytes
from fogon.operators import cubes, search
from fogon.operators.graph import copurchase, delivery, nodes
from fogon.operators.load import Extracted, extract_all, run_etl
from fogon.operators.pages import Listing
from fogon.operators.search_index import SearchIndex
from fogon.session import shared_dir, size_shuffles, tune
from fogon.sources.keys import COMPRESION
from fogon.sources.testdata import SourceTables
from fogon.sources.warehouse import Warehouse

# Rows of narrow tables take a few bytes each in a file, and hundreds in a task that groups them: small files and splits bound its memory.
FILAS_POR_ARCHIVO = 1_000_000
BYTES_POR_LECTURA = "16m"

_CONTEXTS: dict[tuple[str, str], "Context"] = {}


def context(spark: SparkSession, sf_dir: str) -> "Context":
    tune(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CONTEXTS:
        _CONTEXTS[key] = Context(spark, sf_dir)
    spark.conf.set("spark.sql.files.maxPartitionBytes", BYTES_POR_LECTURA)
    # Every derived table is written and read back, so the shuffles of a write are of no use after it. They would stay until the driver's garbage is collected.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return _CONTEXTS[key]


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.src = SourceTables(spark, sf_dir)
        size_shuffles(spark, sum(plan_bytes(self.src.raw(t)) for t in ("orders", "lineitem", "events")))
        self.carpeta = f"{shared_dir(spark)}/fogon-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"
        self.cargadas: dict[str, int] = {}
        self._tablas: dict[str, DataFrame] = {}

    def escrita(self, nombre: str, df: DataFrame) -> DataFrame:
        """``df`` as a written table: later plans start from its files."""
        ruta = f"{self.carpeta}/{nombre}"
        df.write.mode("overwrite").option("maxRecordsPerFile", FILAS_POR_ARCHIVO).parquet(ruta, compression=COMPRESION)
        return self.spark.read.schema(df.schema).parquet(ruta)

    def drop(self) -> None:
        """Delete the written tables of this context."""
        _CONTEXTS.pop((self.spark.sparkContext.applicationId, self.src.sf_dir), None)
        ruta = self.spark._jvm.org.apache.hadoop.fs.Path(self.carpeta)
        ruta.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(ruta, True)

    # --- warehouse ---

    @cached_property
    def relacional(self) -> dict[str, DataFrame]:
        s = self.src
        tablas = {t: getattr(s, t) for t in ("usuario", "restaurante", "producto", "menu", "repartidor")}
        return {**tablas, **{t: s.de_fuente(t, "postgres") for t in ("pedido", "detalle", "reserva")}}

    @cached_property
    def documental(self) -> dict[str, DataFrame]:
        s = self.src
        tablas = {t: getattr(s, t) for t in ("usuario", "restaurante", "producto")}
        return {**tablas, "pedido": s.pedido_doc, "reserva": s.de_fuente("reserva", "mongo")}

    @cached_property
    def extraido(self) -> Extracted:
        return extract_all(self.relacional, self.documental)

    @cached_property
    def almacen(self) -> Warehouse:
        almacen = Warehouse(self.spark, f"{self.carpeta}/warehouse")
        self.cargadas = run_etl(self.extraido, almacen)
        return almacen

    def t(self, nombre: str) -> DataFrame:
        """A warehouse table; its files are listed once, after the load."""
        if nombre not in self._tablas:
            self._tablas[nombre] = self.almacen.table(nombre)
        return self._tablas[nombre]

    tiempo = property(lambda self: self.t("dim_tiempo"))
    categorias = property(lambda self: self.t("dim_categorias"))
    productos = property(lambda self: self.t("dim_productos"))
    pedidos = property(lambda self: self.t("fact_pedidos"))
    reservas = property(lambda self: self.t("fact_reservas"))
    detalle = property(lambda self: self.t("fact_detalle_pedidos"))

    def cubo(self, nombre: str) -> DataFrame:
        ti, ca, pr = self.tiempo, self.categorias, self.productos
        argumentos = {
            "cubo_pedidos_tiempo": (ti, self.pedidos),
            "cubo_reservas_tiempo": (ti, self.reservas),
            "cubo_pedidos_ubicacion": (self.pedidos, ti),
            "cubo_actividad_zona": (self.pedidos, ti),
            "cubo_matriz_od": (self.pedidos, ti),
            "cubo_productos_tiempo": (ti, self.detalle, ca),
            "cubo_productos_ubicacion": (self.detalle, ti, ca),
            "cubo_top_productos_anual": (self.detalle, ti, pr, ca),
            "cubo_frecuencia_uso": (self.detalle, pr, ca),
        }
        return getattr(cubes, nombre)(*argumentos[nombre])

    # --- graph ---

    def _pedido_grafo(self) -> DataFrame:
        return self.src.pedido.withColumnRenamed("fuente_datos", "source_db")

    def _lineas_grafo(self) -> DataFrame:
        return self.src.detalle.withColumnRenamed("fuente_datos", "source_db")

    @cached_property
    def nodos(self) -> dict[str, DataFrame]:
        return {
            "Usuario": nodes.nodes("Usuario", self.src.en_fuentes("usuario")),
            "Producto": nodes.nodes("Producto", self.src.en_fuentes("producto")),
            "Pedido": nodes.nodes("Pedido", self._pedido_grafo()),
            "Restaurante": nodes.nodes("Restaurante", self.src.en_fuentes("restaurante")),
            "Repartidor": nodes.nodes("Repartidor", self.src.en_fuentes("repartidor")),
        }

    @cached_property
    def contiene(self) -> DataFrame:
        lineas = self._lineas_grafo()
        return self.escrita("contiene", nodes.edges_contiene(lineas, self.nodos["Pedido"], self.nodos["Producto"]))

    @cached_property
    def proviene(self) -> DataFrame:
        return self.escrita("proviene", nodes.edges_proviene(self._pedido_grafo(), self.nodos["Pedido"], self.nodos["Restaurante"]))

    @cached_property
    def pertenece(self) -> DataFrame:
        return self.escrita("pertenece", nodes.edges_pertenece(self._pedido_grafo(), self.nodos["Pedido"], self.nodos["Usuario"]))

    @cached_property
    def asignado(self) -> DataFrame:
        return self.escrita("asignado", nodes.edges_asignado(self._pedido_grafo(), self.nodos["Pedido"], self.nodos["Repartidor"]))

    @cached_property
    def refiere(self) -> DataFrame:
        return nodes.edges_refiere(self.nodos["Usuario"])

    @cached_property
    def comprado_con(self) -> DataFrame:
        return self.escrita("comprado_con", copurchase.copurchase(self.contiene, self.nodos["Pedido"]))

    @cached_property
    def distancias(self) -> DataFrame:
        edges = delivery.driver_distances(self.src.en_fuentes("restaurante"), self.src.en_fuentes("repartidor"), 5)
        return self.escrita("distancia", edges)

    @cached_property
    def paradas(self) -> DataFrame:
        asignados = delivery.users_by_driver(self._pedido_grafo(), self.nodos["Usuario"])
        return self.escrita("paradas", delivery.delivery_stops(asignados, self.nodos["Repartidor"]))

    @cached_property
    def entrega(self) -> DataFrame:
        return delivery.delivery_distances(self.paradas)

    # --- search ---

    @cached_property
    def indice(self) -> DataFrame:
        return self.escrita("indice", search.build_search_index(self.src.producto))

    @cached_property
    def tokens(self) -> DataFrame:
        return self.escrita("tokens", search.postings(self.indice))

    @cached_property
    def buscador(self) -> SearchIndex:
        return SearchIndex(self.spark, f"{self.carpeta}/buscador").create(self.indice)

    def _listado(self, nombre: str, orden: list, grupo: str | None = None) -> Listing:
        return Listing(self.spark, f"{self.carpeta}/listado-{nombre}", orden, grupo)

    @cached_property
    def usuarios_listados(self) -> Listing:
        return self._listado("usuarios", ["nombre", "id_usuario"]).write(self.src.usuario.select("id_usuario", "nombre"))

    @cached_property
    def productos_listados(self) -> Listing:
        return self._listado("productos", ["id_producto"], "categoria").write(self.indice)

    @cached_property
    def hallados_listados(self) -> Listing:
        """The products found by one search, best first: later pages of it don't search again."""
        return self._listado("hallados", [F.desc("score"), "id_producto"]).write(self.buscador.search_scores("smal wigdet"))

    def aristas(self) -> dict[str, DataFrame]:
        return {
            "CONTIENE": self.contiene, "COMPRADO_CON": self.comprado_con, "REFIERE": self.refiere,
            "PROVIENE": self.proviene, "PERTENECE": self.pertenece, "ASIGNADO": self.asignado,
            "DISTANCIA": self.distancias, "DISTANCIA_ENTREGA": self.entrega,
        }
