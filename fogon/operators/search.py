"""Product search: index table, typo-tolerant text search, category search, pages, index maintenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default description and the weight of each field.
SIN_DESCRIPCION = "Producto sin descripción"
PESOS = {"nombre": 3.0, "categoria": 2.0, "descripcion": 1.0}

# BM25 constants (Robertson & Zaragoza, 2009).
K1, B = 1.2, 0.75

CAMPOS_INDICE = ["id_producto", "nombre", "categoria", "descripcion", "precio", "id_menu"]


def build_search_index(productos: DataFrame) -> DataFrame:
    return productos.select(*CAMPOS_INDICE).withColumns({
        "descripcion": F.coalesce(F.nullif(F.col("descripcion"), F.lit("")), F.lit(SIN_DESCRIPCION)),
        "precio": F.col("precio").cast("double"),
    })


def tokens(texto: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.filter(F.split(F.lower(texto), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def postings(index: DataFrame) -> DataFrame:
    """(id_producto, campo, token, tf, largo): term counts and field lengths of every product.

    The products are spread before their words are taken, so a file of many products is not counted in the task that reads it.
    """
    campos = F.array(*[F.struct(F.lit(c).alias("campo"), tokens(F.col(c)).alias("palabras")) for c in PESOS])
    por_campo = index.repartition("id_producto").select("id_producto", F.inline(campos)).withColumn("largo", F.size("palabras"))
    return (
        por_campo.select("id_producto", "campo", "largo", F.explode("palabras").alias("token"))
        .groupBy("id_producto", "campo", "token")
        .agg(F.count(F.lit(1)).alias("tf"), F.first("largo").alias("largo"))
    )


def allowed_edits(n: int) -> int:
    """Edits allowed by word length: none up to 2 characters, 1 up to 5, else 2."""
    return 0 if n <= 2 else 1 if n <= 5 else 2


def _max_edits(n: Column) -> Column:
    """``allowed_edits`` of a column."""
    return F.when(n <= 2, 0).when(n <= 5, 1).otherwise(2)


def _swaps(palabra: Column) -> Column:
    """The words that a swap of two neighbouring letters makes of a word."""
    lugares = F.filter(F.sequence(F.lit(1), F.greatest(F.length(palabra) - 1, F.lit(1))), lambda i: i < F.length(palabra))
    return F.transform(lugares, lambda i: F.concat(
        F.substring(palabra, F.lit(1), i - 1), F.substring(palabra, i + 1, F.lit(1)), F.substring(palabra, i, F.lit(1)),
        F.substring(palabra, i + 2, F.length(palabra))))


def edits(token: Column, palabra: Column) -> Column:
    """Edits between two words up to 2, else 3: letters put in, left out or changed, and neighbours swapped."""
    def hasta(otra: Column, mas: int) -> Column:
        d = F.levenshtein(token, otra, 2 - mas)
        return F.when(d >= 0, d + mas).otherwise(3)

    una = _swaps(palabra)
    con_una = F.array_min(F.concat(F.array(F.lit(3)), F.transform(una, lambda w: hasta(w, 1))))
    con_dos = F.when(F.exists(una, lambda w: F.array_contains(_swaps(w), token)), 2).otherwise(3)
    return F.least(hasta(palabra, 0), con_una, con_dos)


def matching(candidates: DataFrame) -> DataFrame:
    """Of pairs (token, palabra) those within the edits that the length of ``palabra`` allows, with ``errores``."""
    palabra = F.col("palabra")
    cercanas = candidates.filter(F.abs(F.length("token") - F.length(palabra)) <= 2).withColumn("errores", edits(F.col("token"), palabra))
    return cercanas.filter(F.col("errores") <= _max_edits(F.length(palabra)))


def weighted(matches: DataFrame, documentos: Column) -> DataFrame:
    """Matches (with df, the number of products that have the token) with their idf and the weight of their typos."""
    return matches.withColumn("idf", F.ln((documentos - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)).withColumn(
        "peso", F.lit(1.0) - F.col("errores") / F.length("palabra"))


def scores(hits: DataFrame) -> DataFrame:
    """(id_producto, score) from postings joined with weighted matches and the mean field lengths (``largo_medio``)."""
    tf = F.col("tf").cast("double")
    bm25 = tf * (K1 + 1) / (tf + (F.col("largo") / F.col("largo_medio") * B + (1 - B)) * K1)
    campo = F.col("campo")
    peso_campo = F.lit(1.0)
    for nombre, peso in PESOS.items():
        peso_campo = F.when(campo == nombre, peso).otherwise(peso_campo)
    return (
        hits.groupBy("id_producto", "campo", "palabra").agg(F.max(F.col("peso") * F.col("idf") * bm25).alias("s"))
        .groupBy("id_producto", "campo").agg((F.sum("s") * F.first(peso_campo)).alias("s"))
        .groupBy("id_producto").agg(F.round(F.max("s"), 6).alias("score"))
    )


def search_scores(indice: DataFrame, q: str) -> DataFrame:
    """All matching products with ``score``; ``indice`` is the token table made by ``postings``.

    Query words are compared with the vocabulary (distinct words per field), not with the products; only
    the postings of words that matched are joined on. A word found by a typo weighs 1 - edits / length. For
    each query word the best matching word of a field counts, the field score is their weighted BM25 sum,
    and the best field gives the score of the product. ``search_index`` keeps such a table, vocabulary and totals up to date.
    """
    documentos = indice.agg(F.count_distinct("id_producto").cast("double")).scalar()
    vocabulario = indice.groupBy("campo", "token").agg(F.count(F.lit(1)).cast("double").alias("df"))
    # The terms of a field add up to its length, so the sum of tf over all products is the sum of lengths.
    largos = indice.groupBy("campo").agg(
        (F.sum("tf").cast("double") / F.count_distinct("id_producto")).alias("largo_medio")
    )
    coincidencias = weighted(matching(vocabulario.select("*", F.explode(F.array_distinct(tokens(F.lit(q)))).alias("palabra"))), documentos)
    # One row per field: safe to broadcast.
    return scores(indice.join(coincidencias, ["campo", "token"]).join(F.broadcast(largos), "campo"))


def paginate(df: DataFrame, orden: list[Column | str], page: int = 1, size: int = 10) -> DataFrame:
    """One page in the given order, each row with the total number of rows."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.orderBy(*orden).offset((page - 1) * size).limit(size).withColumn("total", total)


def search(index: DataFrame, indice: DataFrame, q: str, page: int = 1, size: int = 10) -> DataFrame:
    """One page of products by score; only the page is joined back to the product columns."""
    pagina = paginate(search_scores(indice, q), [F.desc("score"), "id_producto"], page, size)
    return index.join(pagina, "id_producto").orderBy(F.desc("score"), "id_producto")


def search_category(index: DataFrame, cat: str, page: int = 1, size: int = 10) -> DataFrame:
    return paginate(index.filter(F.col("categoria") == cat), ["id_producto"], page, size)


def apply_index_changes(index: DataFrame, changes: DataFrame) -> DataFrame:
    """Index after a batch of changes (``op`` upsert or delete, ordered by ``seq``): the last change of a
    product decides."""
    ultimo = F.max_by(F.struct("op", *CAMPOS_INDICE[1:]), "seq").alias("c")
    finales = changes.groupBy("id_producto").agg(ultimo).select("id_producto", "c.*")
    intactos = index.join(finales.select("id_producto"), "id_producto", "left_anti")
    return intactos.unionByName(build_search_index(finales.filter(F.col("op") == "upsert")))
