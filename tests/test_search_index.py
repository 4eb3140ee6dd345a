"""A search index that follows changes gives what an index built anew gives."""

import random

from pyspark.sql import functions as F

from fogon.operators import search
from fogon.operators.search_index import SearchIndex

COLUMNAS = "id_producto long, nombre string, categoria string, descripcion string, precio double, id_menu long"
PALABRAS = "pizza piza pizzas empanada empandaa café cafe té casado gallopinto olla carne carnes arroz aroz".split()


def _productos(rng, ids):
    def texto():
        return " ".join(rng.choice(PALABRAS) for _ in range(rng.randrange(0, 5)))
    return [(i, texto(), rng.choice(["Bebidas", "Comidas", "Postres"]), rng.choice([None, "", texto()]), 1.0 * i, i % 4) for i in ids]


def _scores(df):
    return sorted(map(tuple, df.collect()))


def test_changes_equal_a_rebuild(spark, tmp_path):
    rng = random.Random(3)
    actual = {p[0]: p for p in _productos(rng, range(60))}
    indice = SearchIndex(spark, str(tmp_path), 4).create(search.build_search_index(spark.createDataFrame(list(actual.values()), COLUMNAS)))
    for vuelta in range(3):
        lote = [(rng.choice(["upsert", "upsert", "delete"]), s, *p) for s, p in enumerate(_productos(rng, [rng.randrange(80) for _ in range(25)]))]
        for op, _, *p in lote:
            if op == "upsert":
                actual[p[0]] = tuple(p)
            else:
                actual.pop(p[0], None)
        indice.apply(spark.createDataFrame(lote, f"op string, seq int, {COLUMNAS}"))
        if vuelta == 1:
            indice.compact()
        nuevo = search.build_search_index(spark.createDataFrame(list(actual.values()), COLUMNAS))
        assert sorted(map(tuple, indice.products().collect())) == sorted(map(tuple, nuevo.collect()))
        for q in ("piza cafe", "empanadas", "aroz", "bebidas", "xyz", "olla de carne"):
            assert _scores(indice.search_scores(q)) == _scores(search.search_scores(search.postings(nuevo), q)), (vuelta, q)
    assert len(indice.versions()) == 2


def test_typo_candidates_are_all_matches(spark, tmp_path):
    """The keys find every word that the comparison with the whole vocabulary finds, and compare far fewer."""
    rng = random.Random(4)
    palabras = {"".join(rng.choice("abcdefghijklmnop") for _ in range(rng.choice([2, 3, 5, 6, 7, 8, 15, 16, 17, 18, 19, 20]))) for _ in range(1500)}
    base = sorted(palabras)[::37]
    for w in base:
        for _ in range(6):
            i = rng.randrange(len(w))
            palabras.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + "z" + w[i:], w[:i] + w[i + 1 : i + 2] + w[i : i + 1] + w[i + 2 :], w[: i // 2] + "yz" + w[i // 2 :]]))
    palabras = sorted(p for p in palabras if p)
    productos = spark.createDataFrame([(i, w, "c", "d", 1.0, 1) for i, w in enumerate(palabras)], COLUMNAS)
    indice = SearchIndex(spark, str(tmp_path), 4).create(search.build_search_index(productos))
    q = " ".join(base[:25])
    vocabulario = spark.createDataFrame([(w,) for w in palabras], "token string").select("token", F.explode(F.split(F.lit(q), " ")).alias("palabra"))
    todas = {(r.token, r.palabra) for r in search.matching(vocabulario).collect()}
    halladas = {(r.token, r.palabra) for r in indice.matches(q).filter("campo = 'nombre'").collect()}
    assert halladas == todas and len(todas) > 40
    assert indice.candidates(q).filter("campo = 'nombre'").count() < 0.05 * len(palabras) * 25


def test_search_reads_postings_once_and_prunes(spark, tmp_path):
    rng = random.Random(5)
    indice = SearchIndex(spark, str(tmp_path), 8).create(search.build_search_index(spark.createDataFrame(_productos(rng, range(40)), COLUMNAS)))
    plan = indice.search_scores("pizza")._jdf.queryExecution().executedPlan().toString()
    lecturas = [x for x in plan.split("\n") if "FileScan" in x]
    assert sum("tf#" in x for x in lecturas) == 1
    # The pruning of the postings reuses the broadcast of the words found, which the plan shows a second time.
    assert sum("quitadas#" in x for x in lecturas) == 2 and "SubqueryAdaptiveBroadcast" in plan
    assert "dynamicpruning" in next(x for x in lecturas if "tf#" in x).lower()
    assert all("cubeta" in x.split("PartitionFilters")[1] for x in lecturas if "quitadas#" in x)


def test_empty_index(spark, tmp_path):
    vacio = spark.createDataFrame([], COLUMNAS)
    indice = SearchIndex(spark, str(tmp_path)).create(search.build_search_index(vacio))
    assert indice.search_scores("pizza").count() == 0 and indice.products().count() == 0
    indice.apply(spark.createDataFrame([("delete", 1, 5, "x", "y", "z", 1.0, 1), ("upsert", 1, 6, "pizza", "y", "", 1.0, 1)], f"op string, seq int, {COLUMNAS}"))
    assert [r.id_producto for r in indice.search_scores("pizza").collect()] == [6] and indice.search_scores("").count() == 0
