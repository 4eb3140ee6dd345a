"""Readers of the operational sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from fogon import schemas

# Text up to the first brace outside strings.
_PREFIJO = r'^(?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+'


def read_relational(spark: SparkSession, table: str, opts: dict[str, str], key: str | None = None, parts: int = 64) -> DataFrame:
    """A relational table: over JDBC when ``opts`` has a ``url``, else a Parquet export under ``path``.

    With ``key``, a whole-number column, a JDBC read takes ``parts`` ranges of it side by side, each a query with its own bounds; the least
    and the greatest key are asked first. Without it the read is one task, unless ``opts`` bring Spark's own bounds.
    Filters and columns are pushed down either way.
    """
    if "url" not in opts:
        return spark.read.parquet(f"{opts['path'].rstrip('/')}/{table}")

    def jdbc(origen: str, **mas: str) -> DataFrame:
        return spark.read.format("jdbc").option("dbtable", origen).option("preferTimestampNTZ", "true").options(**{**opts, **mas}).load()

    if key is None:
        return jdbc(table)
    menor, mayor = jdbc(f"(SELECT MIN({key}) AS menor, MAX({key}) AS mayor FROM {table}) limites").first()
    propias = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
    propias["preferTimestampNTZ"] = "true"
    return spark.read.jdbc(opts["url"], table, predicates=key_ranges(key, menor, mayor, parts), properties=propias)


def key_ranges(key: str, least: int | None, greatest: int | None, parts: int) -> list[str]:
    """Conditions that split the whole numbers from ``least`` to ``greatest`` into at most ``parts`` ranges of nearly equal width.

    Every row meets exactly one of them: the first takes null keys too, and the outer ones are open, for rows that arrive after the
    bounds were asked.
    """
    if least is None or greatest is None:
        return ["1 = 1"]
    least, greatest = int(least), int(greatest)
    ancho = greatest - least + 1
    n = max(1, min(parts, ancho))
    cortes = [least + ancho * i // n for i in range(1, n)]
    if not cortes:
        return ["1 = 1"]
    medio = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cortes, cortes[1:])]
    return [f"{key} < {cortes[0]} OR {key} IS NULL", *medio, f"{key} >= {cortes[-1]}"]


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A document collection exported as JSON lines, with the given schema (no inference)."""
    return spark.read.schema(schema).json(path)


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    """Users out of API responses ``{message, total, usuarios: [...]}``, one response per line."""
    respuestas = spark.read.schema(schemas.RESPUESTA_USUARIOS).json(path)
    return respuestas.select(F.inline("usuarios"))


def read_orders_payload(spark: SparkSession, path: str) -> DataFrame:
    """Orders with their embedded ``detalles``, one order per line."""
    return read_documents(spark, path, schemas.PEDIDO_DOC)


def read_osm_restaurants(spark: SparkSession, path: str) -> DataFrame:
    """Restaurants of OpenStreetMap exports (each one JSON object with an ``elements`` array), a file or a folder of them."""
    return osm_restaurants(map_elements(spark, path))


def map_elements(spark: SparkSession, path: str) -> DataFrame:
    """The elements of map exports, read in splits: a file is one JSON object (or several), but no task needs the whole of it.

    The text is cut at every ``}``, which Spark's text source can do from any place of a file. Whether a piece starts inside a string
    follows from the number of quotes before it, and how deep it lies from the braces outside strings; both are sums over the pieces of a split
    and over the splits of a file. Pieces between two ends of a second-level object make one element, parsed by itself.

    Elements are the objects on the second level, whatever list or field holds them; others than ``elements`` (the export's
    header) have none of an element's fields and come out as rows of nulls. Objects that are not JSON give nulls too.
    """
    piezas = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("archivo"), F.col("_metadata.file_block_start").alias("tramo"),
        F.monotonically_increasing_id().alias("n"), F.col("value").alias("texto"), F.regexp_replace("value", r"\\.", "").alias("limpio"),
    )

    def veces(texto: Column, signo: str) -> Column:
        return F.length(texto) - F.length(F.replace(texto, F.lit(signo)))

    def abiertas(texto: Column) -> Column:
        """Opening braces outside strings, of a text that starts outside of one."""
        return veces(F.regexp_replace(texto, '"[^"]*("|$)', ""), "{")

    limpio = F.col("limpio")
    resto = F.when(F.instr(limpio, '"') > 0, limpio.substr(F.instr(limpio, '"') + 1, F.length(limpio))).otherwise("")
    en_tramo = Window.partitionBy("archivo", "tramo").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    en_archivo = Window.partitionBy("archivo").orderBy("tramo").rowsBetween(Window.unboundedPreceding, -1)

    def antes(valor: Column | str, ventana: WindowSpec) -> Column:
        return F.coalesce(F.sum(valor).over(ventana), F.lit(0))

    # Within a split, for one that starts outside a string (0) and one that starts inside (1).
    medidas = piezas.withColumns({"comillas": veces(limpio, '"') % 2, "abre_fuera": abiertas(limpio), "abre_dentro": abiertas(resto)}).drop("limpio")
    locales = medidas.withColumn("previas", antes("comillas", en_tramo))
    for inicio in (0, 1):
        dentro = (F.col("previas") + inicio) % 2 == 1
        # Every piece but a file's last is followed by a brace, which closes something unless the piece ends inside a string.
        cierra = F.when((F.col("previas") + F.col("comillas") + inicio) % 2 == 0, 1).otherwise(0)
        locales = locales.withColumns({
            f"abre{inicio}": F.when(dentro, F.col("abre_dentro")).otherwise(F.col("abre_fuera")), f"cierra{inicio}": cierra,
        }).withColumn(f"nivel{inicio}", antes(F.col(f"abre{inicio}") - F.col(f"cierra{inicio}"), en_tramo))

    # What a split starts with follows from the splits before it: one row a split.
    cambios = [F.sum(F.col(f"abre{i}") - F.col(f"cierra{i}")).alias(f"cambio{i}") for i in (0, 1)]
    tramos = locales.groupBy("archivo", "tramo").agg(F.sum("comillas").alias("comillas"), *cambios)
    tramos = tramos.withColumn("inicio", antes("comillas", en_archivo) % 2)
    tramos = tramos.withColumn("base", antes(F.when(F.col("inicio") == 0, F.col("cambio0")).otherwise(F.col("cambio1")), en_archivo))

    def segun(nombre: str) -> Column:
        return F.when(F.col("inicio") == 0, F.col(f"{nombre}0")).otherwise(F.col(f"{nombre}1"))

    niveles = locales.join(tramos.select("archivo", "tramo", "inicio", "base"), ["archivo", "tramo"]).select(
        "archivo", "tramo", "n", "texto", (F.col("base") + segun("nivel")).alias("nivel"), segun("abre").alias("abre"), segun("cierra").alias("cierra")
    )
    termina = F.when((F.col("nivel") + F.col("abre") == 2) & (F.col("cierra") == 1), 1).otherwise(0)
    con_fin = niveles.withColumn("termina", termina)
    finales = con_fin.groupBy("archivo", "tramo").agg(F.sum("termina").alias("finales"))
    finales = finales.select("archivo", "tramo", antes("finales", en_archivo).alias("previos"))
    numeradas = con_fin.withColumn("elemento", antes("termina", en_tramo)).join(finales, ["archivo", "tramo"]).withColumn(
        "elemento", F.col("elemento") + F.col("previos")
    )

    # Pieces outside of second-level objects are left out. What stands before an element's own brace: separators, names and, at the start of a file, the outer object.
    sin_prefijo = F.regexp_replace("texto", _PREFIJO, "")
    desde = F.when(F.col("nivel") == 0, F.regexp_replace(F.regexp_replace(sin_prefijo, r"^\{", ""), _PREFIJO, "")).when(
        F.col("nivel") == 1, sin_prefijo).otherwise(F.col("texto"))
    trozos = F.sort_array(F.collect_list(F.struct("tramo", "n", desde.alias("desde"))))
    elementos = numeradas.filter(F.col("nivel") + F.col("abre") >= 2).groupBy("archivo", "elemento").agg(F.array_join(F.transform(trozos, lambda t: t.desde), "}").alias("json"))
    return elementos.select(F.inline(F.array(F.from_json(F.concat("json", F.lit("}")), schemas.ELEMENTO_OSM))))


def osm_restaurants(elements: DataFrame) -> DataFrame:
    """Named restaurant nodes among OSM elements ``(type, lat, lon, tags)``."""

    def tag(nombre: str) -> Column:
        return F.nullif(F.try_element_at("tags", F.lit(nombre)), F.lit(""))

    es_restaurante = (
        (F.col("type") == "node") & (tag("amenity") == "restaurant") & (F.trim(tag("name")) != "")
    )
    direccion = F.coalesce(
        tag("addr:full"), tag("addr:street"), F.concat(tag("addr:city"), F.lit(", Costa Rica")),
        F.lit("San José, Costa Rica"),
    )
    return elements.filter(es_restaurante).select(
        tag("name").alias("nombre"), direccion.alias("direccion"),
        F.col("lat").alias("latitud"), F.col("lon").alias("longitud"),
    )
