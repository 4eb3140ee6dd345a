"""A product search index that follows changes: postings and vocabulary in versions, merged when they are read.

``create`` writes version 0: the products, their postings (in hash buckets of the token), the vocabulary under typo keys and
the totals that scores need. ``apply`` writes a batch of changes as one more version: the new postings, the products whose older rows
no longer count, and by how much document counts and lengths change, all derived from the old and new texts of the changed products only.
A version counts once its mark is written. ``compact`` makes one version of all.

Typo keys of a word are what is left after up to two letters are taken out. Words within two edits share such a key, so a query
word meets its candidates in an equi-join, and only these are compared. A long word is keyed by its length and each of its five parts, of which two
edits leave one as it is, at most two places off. A search reads the buckets of its keys and, by the words found,
the buckets of their postings.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon.operators import search
from fogon.operators.search import CAMPOS_INDICE, tokens

CUBETAS = 16
LARGA = 16  # longer words are keyed by their parts: taking letters out of them would give too many keys
PARTES = 5  # two edits, swaps across a border included, touch four of them at most
TABLAS = ("productos", "postings", "claves", "totales", "borrados")
PRODUCTO = "id_producto bigint, nombre string, categoria string, descripcion string, precio double, id_menu bigint, version int"
ESQUEMAS = {
    "productos": PRODUCTO, "borrados": "id_producto bigint, version int",
    "postings": "id_producto bigint, campo string, token string, tf bigint, largo int, version int, cubeta int",
    "claves": "clave string, quitadas int, campo string, token string, n bigint, cubeta int", "totales": "campo string, documentos bigint, largo bigint",
}


def _bucket(key: Column, n: int) -> Column:
    return (F.crc32(F.encode(key, "UTF-8")) % n).cast("int")


def _without_one(word: Column) -> Column:
    """The words that one letter less makes of a word."""
    lugares = F.filter(F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1))), lambda i: i <= F.length(word))
    return F.transform(lugares, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))


def typo_keys(word: Column) -> Column:
    """(clave, quitadas): what is left of a word, and how many letters were taken out."""
    una = _without_one(word)

    def con(palabras: Column, n: int) -> Column:
        return F.transform(F.array_distinct(palabras), lambda w: F.struct(w.alias("clave"), F.lit(n).alias("quitadas")))

    corta = F.concat(con(F.array(word), 0), con(una, 1), con(F.flatten(F.transform(una, _without_one)), 2))
    largo = F.length(word)

    def parte(i: Column) -> Column:
        desde, hasta = (F.floor(largo * x / PARTES).cast("int") for x in (i, i + 1))
        return F.concat_ws(":", F.concat(F.lit("#"), largo.cast("string")), i.cast("string"), F.substring(word, desde + 1, hasta - desde))

    partes = F.transform(F.sequence(F.lit(0), F.lit(PARTES - 1)), parte)
    return F.when(largo > LARGA, con(partes, 0)).otherwise(corta)


def query_keys(word: str) -> set[str]:
    """Keys under which all words are found that are within the edits ``word`` allows: as many letters taken out."""
    claves = set()
    for n in range(max(len(word) - 2, LARGA + 1), len(word) + 3):
        for i in range(PARTES):
            desde, hasta = n * i // PARTES, n * (i + 1) // PARTES
            claves |= {f"#{n}:{i}:{word[x : x + hasta - desde]}" for x in range(max(0, desde - 2), desde + 3) if x + hasta - desde <= len(word)}
    if len(word) <= LARGA + 2:
        quitadas = [{word}]
        for _ in range(search.allowed_edits(len(word))):
            quitadas.append({w[:i] + w[i + 1 :] for w in quitadas[-1] for i in range(len(w))})
        claves |= set().union(*quitadas)
    return claves


class SearchIndex:
    def __init__(self, spark: SparkSession, base: str, buckets: int = CUBETAS):
        self.spark, self.base, self.buckets = spark, f"{base.rstrip('/')}/c{buckets}", buckets

    def _fs(self, path: str):
        ruta = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return ruta.getFileSystem(self.spark._jsc.hadoopConfiguration()), ruta

    def versions(self) -> list[int]:
        """Numbers of the versions that were written to their end, the newest compaction first of all."""
        fs, ruta = self._fs(self.base)
        if not fs.exists(ruta):
            return []
        nombres = [s.getPath().getName() for s in fs.listStatus(ruta)]
        listas = sorted(int(n) for n in nombres if n.isdigit() and fs.exists(self._fs(f"{self.base}/{n}/_listo")[1]))
        enteras = [n for n in listas if fs.exists(self._fs(f"{self.base}/{n}/_entera")[1])]
        return [n for n in listas if n >= enteras[-1]] if enteras else []

    def _read(self, table: str, versions: list[int] | None = None) -> DataFrame:
        versiones = self.versions() if versions is None else versions
        lector = self.spark.read.schema(ESQUEMAS[table])
        partes = [lector.parquet(f"{self.base}/{v}/{table}") for v in versiones]
        if not partes:
            return self.spark.createDataFrame([], ESQUEMAS[table])
        todas = partes[0]
        for p in partes[1:]:
            todas = todas.unionByName(p)
        return todas

    def _write(self, version: int, products: DataFrame, old: DataFrame | None, gone: DataFrame, whole: bool) -> None:
        ruta = f"{self.base}/{version}"
        con_version = products.select(*CAMPOS_INDICE).withColumn("version", F.lit(version))
        con_version.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in PRODUCTO.split(", ")]).write.mode("overwrite").parquet(f"{ruta}/productos")
        gone.select(F.col("id_producto").cast("bigint"), F.lit(version).alias("version")).write.mode("overwrite").parquet(f"{ruta}/borrados")
        nuevos = search.postings(self.spark.read.schema(PRODUCTO).parquet(f"{ruta}/productos"))
        en_cubetas = nuevos.withColumns({"version": F.lit(version), "cubeta": _bucket(F.col("token"), self.buckets), "tf": F.col("tf").cast("long")})
        en_cubetas = en_cubetas.repartition(self.buckets, "cubeta").sortWithinPartitions("cubeta", "token")
        en_cubetas.write.mode("overwrite").partitionBy("cubeta").parquet(f"{ruta}/postings")
        escritos = self.spark.read.schema(ESQUEMAS["postings"]).parquet(f"{ruta}/postings").select("id_producto", "campo", "token", "tf")
        signo = escritos.withColumn("s", F.lit(1))
        if old is not None:
            signo = signo.unionByName(search.postings(old).select("id_producto", "campo", "token", "tf", F.lit(-1).alias("s")))
        cuentas = signo.groupBy("campo", "token").agg(F.sum("s").alias("n")).filter("n <> 0")
        claves = cuentas.select(F.inline(typo_keys(F.col("token"))), "campo", "token", "n").withColumn("cubeta", _bucket(F.col("clave"), self.buckets))
        claves.repartition(self.buckets, "cubeta").sortWithinPartitions("cubeta", "clave").write.mode("overwrite").partitionBy("cubeta").parquet(f"{ruta}/claves")
        # A product counts once in each field that has words, and once in all.
        por_campo = signo.groupBy("s", "id_producto", "campo").agg(F.sum("tf").alias("largo"))
        campos = por_campo.groupBy("campo").agg(F.sum("s").alias("documentos"), F.sum(F.col("s") * F.col("largo")).alias("largo"))
        todos = por_campo.select("s", "id_producto").distinct().agg(F.coalesce(F.sum("s"), F.lit(0)).alias("documentos"))
        campos.unionByName(todos.select(F.lit("").alias("campo"), "documentos", F.lit(0).cast("long").alias("largo"))).write.mode("overwrite").parquet(f"{ruta}/totales")
        for marca in (["_entera"] if whole else []) + ["_listo"]:
            fs, lugar = self._fs(f"{ruta}/{marca}")
            fs.create(lugar).close()

    def _next(self) -> int:
        return max(self.versions(), default=-1) + 1

    def create(self, index: DataFrame) -> "SearchIndex":
        """Index of the products of ``index`` (as ``build_search_index`` gives them; ids are unique), in place of what there was."""
        self._write(self._next(), index, None, index.select("id_producto").limit(0), True)
        return self

    def _live(self, rows: DataFrame, versions: list[int]) -> DataFrame:
        """Rows of products that no later version has replaced or deleted."""
        if len(versions) == 1:
            return rows
        ultima = self._read("borrados", versions).groupBy("id_producto").agg(F.max("version").alias("_v"))
        return rows.join(ultima, "id_producto", "left").filter(F.col("version") >= F.coalesce("_v", F.lit(0))).drop("_v")

    def products(self) -> DataFrame:
        """The products as of the last version."""
        versiones = self.versions()
        return self._live(self._read("productos", versiones), versiones).select(*CAMPOS_INDICE)

    def apply(self, changes: DataFrame) -> "SearchIndex":
        """A batch of changes (``op`` upsert or delete, ordered by ``seq``): the last change of a product decides.

        Deleting what is not there changes nothing. The work follows the batch; older versions are not rewritten.
        """
        ultimo = F.max_by(F.struct("op", *CAMPOS_INDICE[1:]), "seq").alias("c")
        finales = changes.groupBy("id_producto").agg(ultimo).select("id_producto", "c.*")
        viejos = self.products().join(finales.select("id_producto"), "id_producto", "left_semi")
        nuevos = search.build_search_index(finales.filter(F.col("op") == "upsert"))
        self._write(self._next(), nuevos, viejos, finales.select("id_producto"), False)
        return self

    def compact(self) -> "SearchIndex":
        """All versions as one; the old ones stay on disk for readers that have begun."""
        productos = self.products()
        self._write(self._next(), productos, None, productos.select("id_producto").limit(0), True)
        return self

    def candidates(self, q: str) -> DataFrame:
        """(campo, token, df, palabra) of the words of the index that share a typo key with a word of ``q``."""
        palabras = self.spark.range(1).select(F.array_distinct(tokens(F.lit(q))).alias("p")).first().p
        pares = sorted({(clave, p, search.allowed_edits(len(p))) for p in palabras for clave in query_keys(p)})
        cubetas = sorted({zlib.crc32(clave.encode()) % self.buckets for clave, *_ in pares})
        claves = self._read("claves").filter(F.col("cubeta").isin(cubetas) & F.col("clave").isin([c for c, *_ in pares]))
        cuentas = claves.groupBy("clave", "quitadas", "campo", "token").agg(F.sum("n").cast("double").alias("df")).filter("df > 0")
        juntos = cuentas.join(F.broadcast(self.spark.createDataFrame(pares, "clave string, palabra string, permitidas int")), "clave").filter("quitadas <= permitidas")
        return juntos.groupBy("campo", "token", "palabra").agg(F.first("df").alias("df"))

    def matches(self, q: str) -> DataFrame:
        """(campo, token, df, palabra, errores) of the words of the index that match a word of ``q``."""
        return search.matching(self.candidates(q))

    def search_scores(self, q: str) -> DataFrame:
        """All matching products with ``score``, as ``search.search_scores`` gives it for an index built anew."""
        versiones = self.versions()
        totales = self._read("totales", versiones).groupBy("campo").agg(F.sum("documentos").cast("double").alias("documentos"), F.sum("largo").cast("double").alias("largo"))
        documentos = totales.filter("campo = ''").agg(F.max("documentos")).scalar()
        largos = totales.filter("campo <> ''").select("campo", (F.col("largo") / F.col("documentos")).alias("largo_medio"))
        # The words within two edits of a few words: bounded by their length, not by the index.
        halladas = F.broadcast(search.weighted(self.matches(q), documentos).withColumn("cubeta", _bucket(F.col("token"), self.buckets)))
        hits = self._read("postings", versiones).join(halladas, ["cubeta", "campo", "token"])
        return search.scores(self._live(hits, versiones).join(F.broadcast(largos), "campo"))
